"""brickyard: layered star schemas, data-quality checks, star metrics and batch
retrieval, expressed as PySpark DataFrame transformations.

Every operator takes DataFrames plus plain parameters and returns a lazy
DataFrame; Catalyst plans the whole job. Sinks (``sources.io.write_table``)
and severity enforcement (``operators.quality.enforce``) are the only actions.
"""

__version__ = "0.1.0"
