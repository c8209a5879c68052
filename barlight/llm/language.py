"""Language identification by compression: the language whose zstandard raw-content dictionary packs a text smallest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.llm.common import bounded_batches

UNDECIDED = "und"
SHORT = 1024  # bytes up to which the strongest level packs, whose matches may be three bytes short
STEP = 4  # bytes from one beginning of a short text to the next where whole sizes leave it undecided
RESULT = "lang_pred string, score double, accepted boolean"


@dataclass(frozen=True)
class LanguageModel:
    """Raw dictionary content of each language, and the relative margin below which a prediction is rejected."""

    dictionaries: dict[str, bytes]
    margin: float
    level: int


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    per_text: int = 1024,
    max_languages: int = 256,
    margin: float = 0.002,
    level: int = 3,
) -> LanguageModel:
    """Dictionaries from a bounded sample: about ``per_language`` rows of each language, chosen by a hash of the id, with up to
    ``per_text`` characters of each from its start. This sample is the model's only bound; prediction reads whole texts.

    Rows without a language or a letter teach nothing. More than ``max_languages`` languages raise, none is left out.
    """
    rows = labelled.select(F.col(f"`{lang_col}`").alias("lang"), F.xxhash64(F.col(f"`{id_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text")).filter("lang is not null")
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    chosen = F.lit(False)
    for r in sizes:
        top = int((min(1.0, 1.3 * per_language / max(1, r["n"])) - 0.5) * (1 << 64))
        chosen = chosen | ((F.col("lang") == r["lang"]) & (F.col("h") <= min(top, (1 << 63) - 1)))
    sample = rows.filter(chosen & F.col("text").rlike(r"\p{L}")).groupBy("lang", "h").agg(F.min(F.substring("text", 1, per_text)).alias("text"))
    held: dict[str, list[tuple[int, str]]] = {}
    for r in sample.collect():
        held.setdefault(r["lang"], []).append((r["h"], _letters(r["text"])))
    size = {r["lang"]: r["n"] for r in sizes}
    order = sorted(held, key=lambda k: (-size[k], k))
    return LanguageModel({k: "".join(t for _, t in sorted(held[k])[:per_language]).encode("utf-8", "replace") for k in order}, margin, level)


def _letters(text: str) -> str:
    """Lower-cased words of letters, one space around each: marks, digits and layout say little about a language."""
    import regex

    return " " + " ".join(regex.findall(r"\p{L}+", text.lower())) + " "


def predict(model: LanguageModel, text: Column) -> Column:
    """struct<lang_pred, score, accepted> of a text column.

    The words of a whole text are packed with each dictionary and the smallest wins. Sizes are whole bytes, which says little
    about a text of few words; where the margin is not reached by one of up to ``SHORT`` bytes, the sizes of all its
    beginnings (every ``STEP`` bytes) are added up and compared instead. Of equal sizes, the language with more training rows
    wins, then the smaller name. ``score`` is the relative gain over the second smallest, between 0 and 1; ``accepted`` says
    that it reaches the model's margin. A null text, a text without a letter, or a model without languages gives 'und', 0 and
    false. With one language the score is 1. Repeated rows are judged alike; a very long text is packed as one frame.
    """
    names, contents, margin, level = list(model.dictionaries), list(model.dictionaries.values()), model.margin, model.level

    @F.pandas_udf(RESULT)
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import zstandard as z

        def packers(strength: int) -> list:
            made = []
            for content in contents:
                d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=strength)
                made.append(z.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False, level=strength))
            return made

        usual, strong = packers(level), packers(19)

        def one(text: str | None) -> tuple[str, float, bool]:
            raw = _letters(text).encode("utf-8", "replace") if text and names else b""
            if len(raw) <= 2:
                return UNDECIDED, 0.0, False
            sizes = sorted((len(p.compress(raw)), i) for i, p in enumerate(strong if len(raw) <= SHORT else usual))
            if len(sizes) == 1:
                return names[0], 1.0, True
            gain = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
            if gain < margin and len(raw) <= SHORT:
                ends = range(STEP, len(raw) + STEP, STEP)
                sizes = sorted((sum(len(p.compress(raw[:e])) for e in ends), i) for i, p in enumerate(strong))
                gain = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
            return names[sizes[0][1]], gain, gain >= margin

        for batch in batches:
            yield pd.DataFrame([one(t) for t in batch], columns=["lang_pred", "score", "accepted"])

    return classify(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: CRC-32 of the id as text is 2 modulo 4. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 4 == 2


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row, learned from the rows that are not held out.

    Nulls, empty and long texts, ties and repeated rows are as ``predict`` says; an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)
    model = train(df.filter(~held_out(id_col)), id_col, text_col, lang_col, **options)
    found = df.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col).alias("held_out"), predict(model, F.col(f"`{text_col}`")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")


def keep_accepted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of ``df`` whose language is accepted, with all their columns.

    Null and empty texts and texts without a letter go, and texts that two languages still pack alike; repeated rows stay or
    go together; very long texts are packed whole; an empty table gives no rows.
    """
    bounded_batches(df.sparkSession)
    model = train(df.filter(~held_out(id_col)), id_col, text_col, lang_col, **options)
    kept = df.select(F.struct("*").alias("row"), predict(model, F.col(f"`{text_col}`")).alias("p")).filter("p.accepted")
    return kept.select("row.*")
