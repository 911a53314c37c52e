"""Retrieval and conversation assembly: context, chat history, rewrite prompts
and prompts. The searches themselves are in ``text_index`` (keywords) and
``vectors``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.operators.text_index import (BM25_B, BM25_K1, TOKEN_SPLIT, TermIndex, keyword_topk, term_index,  # noqa: F401
                                            tokens)
from brickyard.operators.vectors import vector_topk, vector_topk_lists  # noqa: F401
from brickyard.session import staged_counting


#: Up to so many hits are sent to every task, about 25 MB, and the texts stay where they are read.
BROADCAST_HITS = 500_000


def assemble_context(ranked: DataFrame, texts: DataFrame, doc_id: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per query: ``Context document {rank}: {text} \\n\\n`` for each hit in
    rank order, concatenated. Groups are bounded by k. The hits are staged."""
    t = texts.select(F.col(doc_id).alias("doc_id"), F.col(text_col).alias("__text"))
    hits, seen = staged_counting(ranked.select("query_id", "rank", "doc_id"), "hits", n=F.count(F.lit(1)))
    j = t.join(F.broadcast(hits) if seen["n"] <= BROADCAST_HITS else hits, "doc_id", "inner")
    g = j.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "__text"))).alias("hits"))
    piece = lambda h: F.concat(F.lit("Context document "), h["rank"].cast("string"),
                               F.lit(": "), h["__text"], F.lit(" \n\n"))
    return g.select("query_id", F.size("hits").alias("n_docs"),
                    F.array_join(F.transform("hits", piece), "").alias("context"))


#: Turn numbers and message positions counted together in one window.
HISTORY_BUCKET = 1000


def chat_history(conversations: DataFrame, n: int = 5, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """For every message, the at most ``n - 1`` messages before it (the last
    ``n`` messages minus the current one), oldest first.

    Messages count by position: turns sort (equal ones by role and text) but
    may have gaps and start anywhere. Positions come from counts per bucket of
    turn numbers, the history from a row frame per bucket of positions, to
    which the last ``n - 1`` messages of the bucket before are added; so a
    conversation that holds a third of all rows spreads over tasks, and a
    text is sent twice, not ``n`` times. Returns ``conv_id, turn, role, text,
    history`` (array of ``struct(turn, role, text)``) and ``n_history``.
    """
    base = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    if n <= 1:
        return base.select("*", empty.alias("history"), F.lit(0).alias("n_history"))
    bucket = F.floor(F.col("turn") / HISTORY_BUCKET)
    rows = base.withColumn("__c", F.struct("conv_id")).withColumn("__t", bucket)
    before = Window.partitionBy("__c").orderBy(F.col("__t").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__c", "__t").agg(F.count(F.lit(1)).alias("__n"))
    start = counts.select("__c", F.struct("__t").alias("__k"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__c", "__t").orderBy("turn", "role", "text")
    placed = (rows.withColumn("__i", F.row_number().over(inside)).withColumn("__k", F.struct("__t")).join(start, ["__c", "__k"])
              .withColumn("__pos", F.col("__start") + F.col("__i") - 1))
    own = F.floor(F.col("__pos") / HISTORY_BUCKET)
    last = F.col("__pos") % HISTORY_BUCKET >= HISTORY_BUCKET - (n - 1)
    dealt = placed.select("__c", "conv_id", "turn", "role", "text", "__pos", F.explode(
        F.when(last, F.array(F.struct(own.alias("b"), F.lit(True).alias("own")), F.struct((own + 1).alias("b"), F.lit(False).alias("own"))))
        .otherwise(F.array(F.struct(own.alias("b"), F.lit(True).alias("own"))))).alias("__d"))
    frame = Window.partitionBy("__c", "__d.b").orderBy("__pos").rowsBetween(-(n - 1), -1)
    message = F.struct(F.col("turn").cast("bigint").alias("turn"), "role", "text")
    out = dealt.withColumn("history", F.collect_list(message).over(frame)).where("__d.own")
    return out.select("conv_id", "turn", "role", "text", "history", F.size("history").alias("n_history"))


def history_text(history: Column) -> Column:
    """``role: text`` lines of a history array joined by newlines."""
    return F.array_join(F.transform(history, lambda m: F.concat(m["role"], F.lit(": "), m["text"])), "\n")


def strip_quotes(c) -> Column:
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, "'", "")


# Our own templates; placeholders in braces.
DEFAULT_TEMPLATE = (
    "Answer the question below from the documents, in the light of the earlier messages.\n"
    "Say that you don't know if the documents don't hold the answer.\n\n"
    "Earlier messages:\n{history}\n\n"
    "Documents:\n{context}\n\n"
    "Question: {question}\n"
)
REWRITE_TEMPLATE = (
    "Turn the last question of this conversation into one that can be understood and searched for by itself. "
    "Reply with that question only.\n\n"
    "Earlier messages:\n{history}\n\n"
    "Last question: {question}\n"
)


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Template with ``{name}`` placeholders -> one ``concat`` expression."""
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(values[m.group(1)], F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def rewrite_prompt(questions: DataFrame, history: DataFrame, template: str = REWRITE_TEMPLATE) -> DataFrame:
    """Per question, the prompt that asks a model for a stand-alone question.

    ``conv_id, turn, question, rewrite`` (whether the question has a history),
    ``rewrite_prompt`` (null without one: the question is then searched as it
    is). The model's answers, as ``conv_id, turn, search_question``, go into
    ``search_questions``; calling the model is the caller's part.
    """
    j = questions.join(history.select("conv_id", "turn", "history"), ["conv_id", "turn"], "left")
    has = F.coalesce(F.size("history"), F.lit(0)) > 0
    filled = fill_template(template, {"history": history_text(F.col("history")), "question": F.col("question")})
    return j.select("conv_id", "turn", "question", has.alias("rewrite"), F.when(has, filled).alias("rewrite_prompt"))


def search_questions(questions: DataFrame, rewritten: DataFrame | None = None, use_history: bool = True) -> DataFrame:
    """``questions`` with the text to search for: the rewritten question where
    there is one and the history is on, else the question itself."""
    if rewritten is None or not use_history:
        return questions.withColumn("search_question", F.col("question"))
    r = rewritten.select("conv_id", "turn", F.col("search_question").alias("__r"))
    return questions.join(r, ["conv_id", "turn"], "left").withColumn("search_question", F.coalesce("__r", "question")).drop("__r")


def assemble_prompt(questions: DataFrame, history: DataFrame, context: DataFrame,
                    template: str = DEFAULT_TEMPLATE, use_history: bool = True) -> DataFrame:
    """Join (question, history, context) on (conv_id, turn) and fill the template.

    questions: conv_id, turn, question, query_id; history: conv_id, turn,
    history; context: query_id, context. With ``use_history`` off, every
    prompt has an empty history.
    """
    h = history.select("conv_id", "turn", "history")
    j = (questions.join(h, ["conv_id", "turn"], "left")
         .join(context.select("query_id", "context"), "query_id", "left"))
    hist = F.coalesce(history_text(F.col("history")), F.lit("")) if use_history else F.lit("")
    has = (F.coalesce(F.size("history"), F.lit(0)) > 0) if use_history else F.lit(False)
    return j.select(
        "conv_id", "turn", has.alias("has_history"),
        fill_template(template, {"history": hist, "context": F.col("context"), "question": F.col("question")}).alias("prompt"))
