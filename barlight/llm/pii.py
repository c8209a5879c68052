"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from barlight.llm.common import texts

NEAR = 48  # characters on either side in which context words count


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds what the plain expression beside it finds, leftmost first, without backtracking over long runs."""

    name: str
    pattern: str
    must_hold: str | None
    valid: str
    score: float
    raises: str
    lowers: str


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
# Kinds in the order that breaks ties between spans of one start.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "true", 0.8, "mail|contact|write", "example|noreply"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), every part at most 255
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)", 0.6, "ip|host|server|address|login", "version|release|section|chapter"),
    # [0-9]([\x20-]?[0-9])+ with 12 to 19 digits that pass Luhn
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, f"length({_DIGITS}) between 12 and 19 and luhn_check({_DIGITS})", 0.7, "card|visa|credit|payment|pay", "order|invoice|isbn|tracking"),
    # \+[0-9][\x20().0-9-]+[0-9] with 9 to 15 digits
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", f"length({_DIGITS}) between 9 and 15", 0.6, "phone|call|tel|mobile|fax", "version|score"),
)
# Added by this method: account numbers whose rearranged digits are 1 modulo 97.
IBAN = Kind(
    "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None,
    "length(replace(m, ' ', '')) between 15 and 34 and aggregate(transform(sequence(1, length(replace(m, ' ', ''))), i -> ascii(substr(concat(substr(replace(m, ' ', ''), 5), left(replace(m, ' ', ''), 4)), i, 1))),"
    " 0, (a, c) -> if(c >= 65, (a * 100 + c - 55) % 97, (a * 10 + c - 48) % 97)) = 1",
    0.7, "iban|account|bank|transfer", "serial|model",
)
ALL = (*KINDS, IBAN)


def _candidates(kind: Kind, number: int) -> Column:
    """Matches of a kind in text order, each with the text before it; one last entry holds what follows the last match.

    Both arrays are whole arguments of one zip, so each pattern runs twice over a text and never once for every match.
    """
    pattern = kind.pattern.replace("\\", "\\\\").replace("'", "\\'")
    gap = "length(g)"
    entries = f"""zip_with(regexp_extract_all(text, '{pattern}', 0), split(text, '{pattern}', -1), (m, g) -> named_struct(
        'kind', {number}, 'gap', {gap}, 'len', length(m), 'valid', if(m is null, false, {kind.valid}),
        'head', lower(left(g, {NEAR})), 'tail', lower(right(g, {NEAR}))))"""
    # a text without a match is one gap and gives nothing
    found = F.expr(entries)
    none = F.expr(entries.replace("regexp_extract_all(text", "regexp_extract_all(''").replace("split(text", "split(''")).getItem(0)
    empty = F.filter(F.array(none), lambda _: F.lit(False))
    must = F.instr("text", kind.must_hold) > 0 if kind.must_hold else F.col("text").rlike("[0-9]")
    return F.when(must, found).otherwise(empty)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row of ``df``: (doc_id, spans), spans being array<struct<start, kind, end, score>> in text order.

    Offsets are code points, the end is exclusive. Matches are leftmost and do not overlap within a kind; a match that fails
    its checksum or count is dropped without a second try. Kinds 0 to 3 are kept at any score; the added kind 4 (iban) needs
    a score of ``least``. A score starts from the kind's own and moves by 0.2 for context words within 48 characters on either
    side. Null and empty texts have no spans. Repeated rows stay apart. The order of spans: start, then kind as listed.

    Patterns run on the JVM, in time proportional to a text however long it is; matches, never texts, are shuffled, by row. An
    empty table gives no rows.
    """
    rows = texts(df, id_col, text_col)
    found = rows.select("uid", "doc_id", F.explode_outer(F.concat(*[_candidates(k, i) for i, k in enumerate(ALL)])).alias("x"), F.monotonically_increasing_id().alias("at"))
    found = found.select("uid", "doc_id", "x.*").withColumn("at", F.monotonically_increasing_id()).repartition("uid")
    w = W.partitionBy("uid", "kind").orderBy("at")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    start = F.sum("gap").over(w) + F.coalesce(F.sum("len").over(before), F.lit(0))
    context = F.concat_ws(" ", "tail", F.lead("head").over(w))
    score = F.lit(0.0)
    for i, k in enumerate(ALL):
        moved = F.lit(k.score) + F.when(context.rlike(k.raises), 0.2).otherwise(0.0) - F.when(context.rlike(k.lowers), 0.2).otherwise(0.0)
        score = F.when(F.col("kind") == i, F.round(moved, 3)).otherwise(score)
    spans = found.withColumns({"start": start.cast("long"), "score": score})
    span = F.struct("start", "kind", (F.col("start") + F.col("len")).alias("end"), "score")
    keep = F.col("valid") & ((F.col("kind") < len(KINDS)) | (F.col("score") >= least))
    return spans.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(keep, span))).alias("spans")).select("doc_id", "spans")


def spell(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in ALL])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

