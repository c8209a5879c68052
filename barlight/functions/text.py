"""URL, label and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlight.functions.numeric import as_col

# Label spellings and the class each one means.
LABEL_CLASSES = {
    "positive": "positive",
    "pos": "positive",
    "label_2": "positive",
    "negative": "negative",
    "neg": "negative",
    "label_0": "negative",
    "neutral": "neutral",
    "label_1": "neutral",
}

URL_HEAD = r"^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?)"


def canonical_url(url: Column | str) -> Column:
    """Scheme and authority lower-cased, query and fragment dropped, path as is; null gives ''."""
    url = F.coalesce(as_col(url), F.lit(""))
    head = F.regexp_extract(url, URL_HEAD, 1)
    tail = F.substr(url, F.length(head) + 1)
    return F.concat(F.lower(head), F.regexp_replace(tail, r"(?s)[?#].*$", ""))


def as_text(c: Column | str) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def text_key(c: Column | str) -> Column:
    return F.sha2(as_text(c), 256)


def short_key(c: Column | str) -> Column:
    return F.substring(text_key(c), 1, 12)


def shorten(c: Column | str, max_length: int = 512) -> Column:
    """Guard for a model that reads at most ``max_length`` tokens: four characters per token."""
    return F.substring(as_text(c), 1, max_length * 4)


def first_text(*candidates: Column | str) -> Column:
    return F.coalesce(*[as_col(c) for c in candidates], F.lit(""))


def standard_label(label: Column | str, id2label: dict[int, str] | None = None) -> Column:
    """The class a label means: the fixed spellings first, then ``id2label``, a model's own names by id.

    An id may be given as ``label_{id}`` or as itself; its name may be one of the fixed spellings too.
    """
    clean = F.lower(F.trim(F.coalesce(as_col(label), F.lit(""))))
    classes = dict(LABEL_CLASSES)
    for i, name in (id2label or {}).items():
        own = name.strip().lower()
        for spelling in (f"label_{i}", str(i)):
            classes.setdefault(spelling, LABEL_CLASSES.get(own, own))
    known = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    return F.when(F.coalesce(as_col(label), F.lit("")) == "", F.lit("neutral")).otherwise(
        F.coalesce(F.try_element_at(known, clean), clean)
    )


def signed_score(label: Column | str, prob: Column | str) -> Column:
    std, p = standard_label(label), as_col(prob).cast("double")
    return F.when(std == "positive", p).when(std == "negative", -p).otherwise(F.lit(0.0))


def score_label(score: Column | str, margin: float = 0.05) -> Column:
    s = as_col(score)
    return F.when(s > margin, F.lit("positive")).when(s < -margin, F.lit("negative")).otherwise(F.lit("neutral"))


def ticker_key(ticker: Column | str) -> Column:
    return F.regexp_replace(F.upper(as_col(ticker)), "/", "-")


def base_symbol(ticker: Column | str) -> Column:
    return F.split_part(as_col(ticker), F.lit("."), F.lit(1))


def expanded_query(ticker: Column | str, company: Column | str | None = None) -> Column:
    """ticker OR base OR "company" OR base stock OR base news; no company, no company term."""
    t, base = as_col(ticker), base_symbol(ticker)
    name = F.lit(None).cast("string") if company is None else as_col(company)
    quoted = F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit('"'), name, F.lit('"')))
    return F.concat_ws(" OR ", t, base, quoted, F.concat(base, F.lit(" stock")), F.concat(base, F.lit(" news")))


def query_terms(query: Column | str) -> Column:
    """Lower-case terms of an ' OR ' query; a plain string is the query itself."""
    q = F.lit(query) if isinstance(query, str) else query
    return F.transform(F.split(q, " OR "), lambda t: F.lower(F.trim(t)))


def mentions_any(terms: Column, *fields: Column | str) -> Column:
    texts = [F.lower(F.coalesce(as_col(f), F.lit(""))) for f in fields]

    def hit(term: Column) -> Column:
        found = F.contains(texts[0], term)
        for text in texts[1:]:
            found = found | F.contains(text, term)
        return found

    return F.exists(terms, hit)
