"""Personal data by patterns, checksums and context (operator 9, native).

A regular expression per kind proposes spans; validators confirm them (Luhn
for cards, mod-97 for account numbers, number ranges for addresses); words
near the span raise or lower its score.  Spans of the base kinds that pass
their validator always stay; spans of the added kinds need a score of at least
``THRESHOLD``.

Positions without a UDF: splitting a text by the pattern gives the gaps
between the matches, so a running sum over gap and match lengths per document
gives every start.  Gaps and matches are exploded into rows (only for texts
that hold a proposal), so a text with very many spans costs linear work.

The patterns accept the same spans as their plain forms but use possessive
repeats and look-behinds, so that long runs of digits or letters are scanned
once instead of once per start.

Defined results: a null or empty text has no spans; repeated rows each get
their spans; spans of different kinds may overlap, spans of one kind do not;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareflow.llm.common import unpacked, whole_row

THRESHOLD = 0.6
CONTEXT_CHARS = 48


@dataclass(frozen=True)
class Kind:
    """``score`` is that of a confirmed span before its context is read."""
    name: str
    pattern: str
    score: float
    base: bool
    raised_by: str
    lowered_by: str = ""


# Patterns and context words.  The order is the output order.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.9, True, "mail|contact|write|schreib|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         0.6, True, "ip|host|server|address|login|client", "version|release|section|chapter"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
         0.8, True, "card|visa|mastercard|amex|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]",
         0.7, True, "phone|call|tel|mobile|fax|telefon|llame"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         0.8, False, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         0.4, False, "ssn|social|security|tax"),
    Kind("tel", r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         0.4, False, "phone|call|tel|mobile|fax|telefon|llame", "order|invoice|part|serial"),
)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a short digit string (the last digit is the check digit)."""
    d = F.split(F.reverse(digits), "")
    weighted = F.transform(d, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        F.when(x.cast("int") > 4, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)))
    return F.aggregate(weighted, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of an account number without blanks: letters are 10 to 35."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))
    number = F.split(turned, "")
    value = lambda x: F.when(x.between("0", "9"), F.ascii(x) - 48).otherwise(F.ascii(x) - 55)
    return F.aggregate(number, F.lit(0), lambda a, x: F.when(
        x.between("0", "9"), (a * 10 + value(x)) % 97).otherwise((a * 100 + value(x)) % 97)) == 1


def _confirmed(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    ip = F.forall(parts, lambda p: (F.length(p) <= 3)
                  & (F.coalesce(F.when(F.length(p).between(1, 3), p).cast("int"), F.lit(0)) <= 255))
    account = F.replace(match, F.lit(" "), F.lit(""))
    return (F.when(kind == "ip", ip)
            .when(kind == "card", n.between(14, 19) & luhn(digits))
            .when(kind == "phone", n.between(10, 15))
            .when(kind == "iban", F.length(account).between(15, 34) & mod97(account))
            .otherwise(F.lit(True)))


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``row_key, kind, rank, base, start, end, score``: code points, end exclusive."""
    t = F.col("__t")
    proposed = [
        F.when(t.rlike(k.pattern), F.struct(
            F.lit(i).alias("rank"),
            F.split(t, k.pattern, -1).alias("gaps"),
            F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0)).alias("found")))
        for i, k in enumerate(KINDS)]
    any_kind = F.lit(False)
    for k in KINDS:
        any_kind = any_kind | t.rlike(k.pattern)
    held = (docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("__t"))
            .filter(any_kind).dropDuplicates(["row_key"])
            .select("row_key", F.explode(F.filter(F.array(*proposed), lambda p: p.isNotNull()))
                    .alias("p")))
    gaps, found = F.col("p.gaps"), F.col("p.found")
    pieces = F.transform(found, lambda m, i: F.struct(
        m.alias("match"), F.length(gaps[i]).alias("gap"),
        F.right(gaps[i], F.lit(CONTEXT_CHARS)).alias("before"),
        F.left(gaps[i + 1], F.lit(CONTEXT_CHARS)).alias("after")))
    rows = held.select("row_key", F.col("p.rank").alias("rank"), F.posexplode(pieces).alias("at", "x"))
    upto = W.partitionBy("row_key", "rank").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    size = F.length("x.match")
    rows = rows.select(
        "row_key", "rank", "x",
        (F.sum(F.col("x.gap") + size).over(upto)).cast("long").alias("end"))
    pick = lambda f: F.array(*[F.lit(f(k)) for k in KINDS])[F.col("rank")]
    near = F.lower(F.concat_ws(" ", "x.before", "x.after"))
    words = lambda f: F.lit(False) if not any(map(f, KINDS)) else F.coalesce(
        *[F.when((F.col("rank") == i), near.rlike(rf"(?<![a-z])(?:{f(k)})"))
          for i, k in enumerate(KINDS) if f(k)], F.lit(False))
    score = (pick(lambda k: k.score)
             + F.when(words(lambda k: k.raised_by), F.lit(0.3)).otherwise(F.lit(0.0))
             - F.when(words(lambda k: k.lowered_by), F.lit(0.3)).otherwise(F.lit(0.0)))
    out = rows.select("row_key", pick(lambda k: k.name).alias("kind"), "rank",
                      pick(lambda k: k.base).alias("base"),
                      (F.col("end") - size).alias("start"), "end", F.col("x.match").alias("match"),
                      F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))
    return (out.filter(_confirmed(F.col("kind"), F.col("match")))
            .filter(F.col("base") | (F.col("score") >= threshold)).drop("match"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, found`` (structs by start, then kind)."""
    per_doc = (spans(docs, id_col, text_col).groupBy("row_key")
               .agg(F.sort_array(F.collect_list(F.struct(
                   "start", "rank", "end", "kind", "base", "score"))).alias("found")))
    ids = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"))
    return (ids.join(per_doc, "row_key", "left")
            .withColumn("found", F.coalesce("found", F.array().cast(
                per_doc.schema["found"].dataType)))
            .select("doc_id", "found"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets.

    Overlapping spans are replaced together, by the kind that starts first.
    """
    s = spans(docs, id_col, text_col)
    by_start = W.partitionBy("row_key").orderBy("start", "rank", "end")
    before = F.max("end").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    s = s.withColumn("new", F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0))
    s = s.withColumn("island", F.sum("new").over(
        by_start.rowsBetween(W.unboundedPreceding, 0)))
    islands = s.groupBy("row_key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min_by("kind", F.struct("start", "rank")).alias("kind"))
    cuts = islands.groupBy("row_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    d = docs.select(whole_row(docs).alias("row"), row_key(id_col, text_col).alias("row_key"))
    d = d.join(cuts, "row_key", "left")
    c, t = F.col("cuts"), F.col("row")[text_col]
    parts = F.transform(c, lambda x, i: F.concat(
        F.substr(t, F.when(i == 0, F.lit(1)).otherwise(c[F.greatest(i - 1, F.lit(0))]["end"] + 1)
                 .cast("int"),
                 (x["start"] - F.when(i == 0, F.lit(0)).otherwise(
                     c[F.greatest(i - 1, F.lit(0))]["end"])).cast("int")),
        F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = F.substr(t, (F.element_at(c, -1)["end"] + 1).cast("int"))
    d = d.withColumn("new", F.when(c.isNotNull(), F.concat(F.array_join(parts, ""), tail)))
    changed = {text_col: F.coalesce(F.col("new"), t)}
    if length_col is not None and length_col in docs.columns:
        changed[length_col] = (F.when(F.col("new").isNull(), F.col("row")[length_col])
                               .otherwise(F.length("new")).cast(docs.schema[length_col].dataType))
    return d.select(*unpacked(docs, "row", changed))
