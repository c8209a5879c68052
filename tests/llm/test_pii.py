from __future__ import annotations

import random
import re

from brute import awkward, empty

from barlight.llm import pii

# The plain expressions, tried leftmost first by another engine.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind: str, m: str) -> bool:
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        out += [(m.start(), i, m.end()) for m in re.finditer(pattern, text) if holds(kind, m[0])]
    return sorted(out)


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.spans for r in pii.find_pii(df).collect()}


def test_base_spans_equal_the_plain_expressions(spark):
    rng = random.Random(7)
    parts = ["a@b.c", "_d@e.f", "x.y+z@mail.example.com", "1.2.3.4", "256.1.1.1", "010.0.0.255", ".5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+49", "@", "é", "𝒳", " ", "-", "..", "%", "7", "\n", "ß"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in got[i] if s.kind < 4] == base_spans(t), t


def test_iban_by_checksum_and_context_scores(spark):
    got = found(spark, ["account iban GB82 WEST 1234 5698 7654 32 please", "GB82 WEST 1234 5698 7654 33", "pay by card 4111111111111111 now", "order 4111111111111111"])
    assert [(s.kind, s.start, s.end) for s in got[0] if s.kind == 4] == [(4, 13, 40)]
    assert not [s for s in got[1] if s.kind == 4]
    assert got[2][0].score > 0.7 > got[3][0].score


def test_long_runs_take_linear_time(spark):
    got = found(spark, ["7" * 200_000, "a" * 200_000, "1 " * 100_000, "a." * 100_000 + "@", "+1" + "-" * 100_000])
    assert all(not s for s in got.values())


def test_awkward_rows_and_an_empty_table(spark):
    df = awkward(spark)
    got = pii.find_pii(df).collect()
    assert len(got) == df.count() and all(r.spans is not None for r in got)
    assert pii.find_pii(empty(spark)).count() == 0

