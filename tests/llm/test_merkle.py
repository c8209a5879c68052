from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from brute import awkward, empty

from barlight.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = [r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, path of each leaf): path entries are (sibling or None, whether it stands left)."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            path.append((nodes[i ^ 1] if i ^ 1 < len(nodes) else None, i % 2 == 1))
        at = [i // 2 for i in at]
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        made[lang] = tree([leaf(r) for r in groups[lang]])
    root, upper = tree([made[x][0] for x in langs]) if langs else (None, [])
    out = Counter()
    for lang, above in zip(langs, upper, strict=True):
        subroot, paths = made[lang]
        for r, own in zip(groups[lang], paths, strict=True):
            path = own + above
            cheated = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            x = leaf(r, 1 if cheated else 0)
            for sib, left in path:
                x = digest(sib, x) if left else digest(x, sib or "")
            out[(r.doc_id, leaf(r), subroot, root, digest(*(s for s, _ in path if s)), x, x == root)] += 1
    return out


def check(df, **more):
    got = Counter(tuple(r) for r in merkle.manifest(df, **more).collect())
    assert got == brute(df.collect())


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, digest string, part string, n string"


def rows(n, langs, seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice("aé𝔠 ") for _ in range(rng.randrange(9)))
    return [(i, rng.choice(["s", None]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, text()]), "t", "p", "d", "x", "n") for i in range(n)]


@pytest.mark.parametrize("n, langs, every", [(1, ["en"], 5), (2, [None], 5), (33, ["en"], 5), (70, ["en", "de", None, "", "ÿ", "𝔠"], 2), (40, [str(i) for i in range(30)], 3)])
def test_against_whole_trees(spark, n, langs, every):
    check(spark.createDataFrame(rows(n, langs, n), SCHEMA).repartition(3), every=every)


def test_one_language_holds_most_rows_and_a_row_repeats(spark):
    some = rows(900, ["en"], 5) + rows(7, ["de", "fr"], 6) + [(17, "s", "en", 3, "again", "t", "p", "d", "x", "n")] * 400
    check(spark.createDataFrame(some, SCHEMA).repartition(6))


def test_every_level_stored_and_one_for_all(spark):
    df = spark.createDataFrame(rows(120, ["en", "de"], 9), SCHEMA)
    for every in (1, 12):
        check(df, every=every)


def test_only_every_few_levels_are_stored(spark):
    leaves = spark.range(1000).selectExpr("'' as tree", "id as pos", "1000L as n", "sha2(string(id), 256) as digest")
    made = merkle.build(leaves, 4)
    assert [x.count() for x in made.levels] == [1000, 63, 4, 1]


def test_awkward_rows_and_an_empty_table(spark):
    check(awkward(spark))
    assert merkle.manifest(empty(spark)).collect() == []
