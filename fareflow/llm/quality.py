"""Quality rules by cross-document line frequency (operator 1, native).

Base statistics are column expressions over each whole text.  The method
hashes every normalised line (lower case, white space runs as one space,
trimmed), counts per host on how many documents of different text the line
occurs, and removes lines above the limits: at least ``min_docs`` documents,
and more than ``host_percent`` of the host's documents or more than
``enough_docs``.  The percentage guards small hosts; on large ones the fixed
count decides, so a line is judged alike however much its host grows.  A
document that loses more than ``depleted_share`` of its words this way is
rejected, as is one that fails the base rules.

Counting documents of different text, not rows, keeps a group of exact copies
from being rejected as boilerplate.  Only hashes are shuffled; a line that is
in a third of all rows is first reduced to one row per text, then counted with
partial sums, and the join with the few frequent lines leaves skew to AQE.

Defined results: a null text is empty (no words, fails the base rules); a null
source is a host of its own; repeated rows each get their row's result; an
empty table gives an empty result; other columns are ignored by the statistics
and carried through unchanged by ``apply_rules``.  A text of any length is read
whole in one row.  Every limit is strict as written, so equal counts (ties)
fall on one side always: a line on exactly ``host_percent`` of a small host and a
document that loses exactly ``depleted_share`` of its words stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import unpacked, whole_row

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 20
HOST_PERCENT = 2
ENOUGH_DOCS = 100
DEPLETED_SHARE = 0.5

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def _without(c: Column, chars: str) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def _row_key(id_col: str, host_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(host_col), F.col(text_col))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """One row per document: ``row_key, doc_id`` and the base statistics."""
    text = F.col("__t")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(F.col(id_col).alias("doc_id"),
                    _row_key(id_col, host_col, text_col).alias("row_key"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    d = d.select("doc_id", "row_key", words_of(text).alias("__w"), lines.alias("__l"),
                 F.length(_without(text, WHITE_CHARS)).cast("long").alias("word_chars"),
                 (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"))
    n = F.size("__w")
    w = F.col("__w")
    # Hash of each 3-word window; positions only matter where one repeats.
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    d = d.select("doc_id", "row_key", "word_chars", "n_symbols", n.cast("long").alias("n_words"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 windows.alias("__h"))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    placed = F.when(repeats, F.sort_array(F.transform(
        "__h", lambda h, i: F.struct(h.alias("h"), i.alias("at")))))
    d = d.withColumn("__s", placed).drop("__h")
    s = F.col("__s")
    twice = F.filter(s, lambda x, j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == x["h"]))
                     | ((j < F.size(s) - 1)
                        & (s[F.least(j + 1, F.size(s) - 1)]["h"] == x["h"])))
    starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
    # Words covered by the repeated windows: union of [start, start + 3).
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"),
                                (p + 3).alias("end")),
        lambda acc: acc["n"])
    return d.select("doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[\x20\x09\x0B-\x0D]+", " "))


def normal_lines(text: Column) -> Column:
    """Normalised lines of a text, in order, aligned with ``split(text, '\\n')``."""
    return F.transform(F.split(text, "\n"), _normal)


def _line_rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``row_key, text_key, host, line, words``: one row per distinct line of a document."""
    lines = F.col("__n")
    d = docs.select(_row_key(id_col, host_col, text_col).alias("row_key"),
                    F.xxhash64(F.col(text_col)).alias("text_key"), F.col(host_col).alias("host"),
                    normal_lines(F.coalesce(F.col(text_col), F.lit(""))).alias("__n"))
    counted = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.struct(
        F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
                                      + 1).alias("words")))
    return d.select("row_key", "text_key", "host", F.inline(counted))


def frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   host_col: str = "source", min_docs: int = MIN_DOCS,
                   host_percent: int = HOST_PERCENT, enough_docs: int = ENOUGH_DOCS) -> DataFrame:
    """``host, line, n_docs`` of the lines above the limits."""
    rows = _line_rows(docs, id_col, text_col, host_col)
    counts = (rows.select("host", "line", "text_key").distinct()
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")))
    hosts = (docs.select(F.col(host_col).alias("host"), F.xxhash64(F.col(text_col)).alias("k"))
             .distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")))
    h = hosts.select(F.col("host").alias("__host"), "host_docs")
    return (counts.filter(F.col("n_docs") >= min_docs)
            .join(h, F.col("host").eqNullSafe(F.col("__host")))
            .filter((100 * F.col("n_docs") > host_percent * F.col("host_docs"))
                    | (F.col("n_docs") > enough_docs))
            .select("host", "line", "n_docs"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", **limits) -> DataFrame:
    """``row_key, n_removed_words, removed`` (hashes) of documents that lose lines."""
    rows = _line_rows(docs, id_col, text_col, host_col)
    often = (frequent_lines(docs, id_col, text_col, host_col, **limits)
             .select(F.col("host").alias("__host"), F.col("line").alias("__line")))
    # Repeated rows share a key; the distinct lines of one are what both lose.
    hit = rows.join(often, (rows["line"] == often["__line"])
                    & rows["host"].eqNullSafe(often["__host"]))
    per_line = hit.groupBy("row_key", "line", "words").agg(F.count(F.lit(1)).alias("n"))
    return per_line.groupBy("row_key").agg(
        F.sum(F.col("words") * F.col("n")).cast("long").alias("__lost"),
        F.collect_set("line").alias("removed"))


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", depleted_share: float = DEPLETED_SHARE,
             **limits) -> DataFrame:
    """Base statistics, ``base_failed``, ``n_removed_words`` and ``kept`` per document."""
    stats = base_statistics(docs, id_col, text_col, host_col)
    lost = removed_lines(docs, id_col, text_col, host_col, **limits)
    copies = (docs.select(_row_key(id_col, host_col, text_col).alias("row_key"))
              .groupBy("row_key").agg(F.count(F.lit(1)).alias("__copies")))
    lost = (lost.join(copies, "row_key")
            .select("row_key", "removed",
                    (F.col("__lost") / F.col("__copies")).cast("long").alias("n_removed_words")))
    out = (stats.join(lost, "row_key", "left")
           .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
           .withColumn("base_failed", base_failed()))
    depleted = F.col("n_removed_words") > F.col("n_words") * depleted_share
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source", length_col: str | None = "n_chars",
                **limits) -> DataFrame:
    """The documents that pass, without the lines above the limits."""
    # One row per key before the filter: pushed below the statistics, the
    # filter would have the words of a text split anew for each of its windows.
    found = (verdicts(docs, id_col, text_col, host_col, **limits).groupBy("row_key")
             .agg(F.any_value("kept").alias("kept"), F.any_value("removed").alias("removed"))
             .filter("kept").drop("kept"))
    d = docs.select(whole_row(docs).alias("row"),
                    _row_key(id_col, host_col, text_col).alias("row_key")).join(found, "row_key")
    text = F.col("row")[text_col]
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("removed"),
                                                                     F.xxhash64(_normal(x))))
    new = F.when(F.col("removed").isNull(), text).otherwise(F.array_join(kept, "\n"))
    changed = {text_col: new}
    if length_col is not None and length_col in docs.columns:
        changed[length_col] = (F.when(F.col("removed").isNull(), F.col("row")[length_col])
                               .otherwise(F.length(new)).cast(docs.schema[length_col].dataType))
    return d.select(*unpacked(docs, "row", changed))
