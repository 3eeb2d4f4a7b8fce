"""Filter audit and ranked search against brute force on small tables with awkward rows."""

import re
from itertools import permutations

import pytest

from tickline.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(70))
AUDIT_DOCS = [
    (1, LONG, "s"), (2, LONG, "s"), (2, LONG, "s"), (3, LONG, None), (4, LONG + " #", ""), (5, None, "s"), (6, "", "t"),
    (7, "A B " * 40, "t"), (None, LONG, "t"), (None, None, "t"), (8, "x " * 30 + "\x0by z", "hot"), (9, "é" * 5000 + " ABC$", "hot"), (10, "x " * 30 + "\x0by z", "s"), (1, "ONE|", "s"),
]
AUDIT_LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (5, 0, 1), (7, 1, 1), (8, None, 0), (None, 1, 1), (99, 1, 1)]


def audit_by_hand(docs, labels):
    out = {}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, part in docs:
        t, part = t or "", part or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" if len(w) < 50 else ""
        fails += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        fails += "D" if re.search(r"[#$%&*|]", t) else ""
        fails += "E" if i is not None and i > least[t] else ""
        good = i is not None and any(a == i and q == 1 for a, q, _ in labels)
        toxic = i is not None and any(a == i and x == 1 for a, _, x in labels)
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, "".join(order), step), [0] * 6)
                hit = f in fails
                row[0] += not gone and not hit
                row[1] += not gone and hit
                row[2] += gone and hit
                row[3] += fails == f
                row[4] += not gone and hit and good
                row[5] += not gone and hit and toxic
                gone = gone or hit
    shapley = {}
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + row[1]
    return {(p, o, s, *row, shapley[p, o[s - 1]]) for (p, o, s), row in out.items()}


COUNTS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit_matches_brute_force(spark):
    rows = [(*r, 7, "clash") for r in AUDIT_DOCS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mask int, part string").repartition(3)
    labels = spark.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.document_masks(docs, labels)).select(COUNTS).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == audit_by_hand(AUDIT_DOCS, AUDIT_LABELS)
    empty = filter_audit.audit(filter_audit.document_masks(docs.where("1 = 0"), labels))
    assert empty.count() == 0 and empty.columns.sort() == COUNTS.sort()
    unlabelled = filter_audit.audit(filter_audit.document_masks(docs, labels.where("1 = 0"))).select("good_lost", "toxic_lost").distinct().collect()
    assert [tuple(r) for r in unlabelled] == [(0, 0)]


@pytest.mark.parametrize("letters", ["A", "BA", "CAB"])
def test_removal_ranks_are_the_first_failing_step(spark, letters):
    masks = spark.range(1 << len(letters)).selectExpr("cast(id as int) AS mask")
    for r in masks.select("mask", filter_audit.removal_ranks(masks["mask"], letters).alias("ranks")).collect():
        for order, rank in zip(permutations(letters), r["ranks"], strict=True):
            steps = [order.index(x) + 1 for k, x in enumerate(letters) if r["mask"] >> k & 1]
            assert rank == min(steps) if steps else rank >= filter_audit.NEVER


VOCAB = [f"t{i}" for i in range(40)]
SEARCH_DOCS = [
    *[(i, " ".join(VOCAB[(i * j) % 40] for j in range(1, 3 + i % 9)) + " Common The", "s") for i in range(60)],
    (60, None, "s"), (61, "", "s"), (62, " -- ", "s"), (63, "t1,T1;t1 é1\x00t2", "s"), (63, "t1,T1;t1 é1\x00t2", "s"), (None, "t5 t6 only", "s"), (64, "t7 " * 30000, "s"), (7, "another text t3 of id seven", "s"),
]
SEARCH_ITEMS = [(1, "t1 T2 common"), (1, "t39"), (2, "the"), (3, None), (4, ""), (5, "unseen words"), (None, "t5 t7 t7"), (6, " ".join(VOCAB)), (7, "é1"), (8, "t3 t3 t3")]


def search_by_hand(docs, items, k):
    import math

    def terms(t):
        return [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]

    own = [(i, terms(t)) for i, t, _ in docs if terms(t)]
    n_docs, total = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, t in own:
            m = 10 + 90 * len(t) * n_docs // total
            s = 0
            for x in ts & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                s += w * (1000000000 * t.count(x) // (1000 * t.count(x) + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda y: y[:2] + (y[2] or 0,))[:k], 1)]
    return out


@pytest.mark.parametrize("k, options", [(10, {}), (3, {"block_docs": 7, "bundle_items": 2}), (2, {"block_docs": 20, "term_block": 9, "bundle_terms": 5})])
def test_ranked_search_matches_brute_force(spark, tmp_path, k, options):
    from tickline.llm import ranked_search

    spark.createDataFrame([(*d, 1, 2) for d in SEARCH_DOCS], "doc_id long, text string, item string, score int, row int").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    items = spark.createDataFrame([(*i, 9) for i in SEARCH_ITEMS], "item_id long, text string, term int")
    got = ranked_search.search(docs, items, k, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, search_by_hand(SEARCH_DOCS, SEARCH_ITEMS, k)))


def test_ranked_search_of_empty_tables(spark):
    from tickline.llm import ranked_search

    docs = spark.createDataFrame(SEARCH_DOCS, "doc_id long, text string, source string")
    items = spark.createDataFrame(SEARCH_ITEMS, "item_id long, text string")
    assert ranked_search.search(docs.where("1 = 0"), items).count() == 0
    assert ranked_search.search(docs, items.where("1 = 0")).count() == 0
