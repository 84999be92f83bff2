from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bondscope.llm import near_dedup
from bondscope.llm.common import hash_words
from bondscope.llm.exact_dedup import drop_exact_copies, exact_groups
from bondscope.llm.near_dedup import bag_min_hash, components, drop_near_copies, near_classes, overlap
from tests.llm.samples import DOCS, awkward, clashing, frame, row, text

WHITE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(WHITE)].append(r)
    out = Counter()
    for members in groups.values():
        ranked = sorted(members, key=lambda r: (-len(r[1] or ""), r[0] is not None, r[0] or 0))
        for n, r in enumerate(ranked):
            out[r[0], ranked[0][0], len(members), n == 0] += 1
    return out


@pytest.mark.parametrize("copies", [1, 700])
def test_exact_groups_agree_with_brute_force(spark, copies):
    rows = awkward() + [row(100 + n, "a hot  text" if n % 2 else "a hot text") for n in range(copies)]
    rows += [row(2000 + n, text(n % 40)) for n in range(200)]
    # several tasks, so that a group crosses their borders
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_groups(clashing(frame(spark, rows))).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == brute_groups(rows)


def test_exact_copies_are_dropped_with_all_columns_kept(spark):
    rows = awkward()
    docs = clashing(frame(spark, rows))
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").translate(WHITE) for r in left.collect()]
    assert sorted(texts) == sorted({(r[1] or "").translate(WHITE) for r in rows})


def test_no_documents(spark):
    empty = frame(spark, [])
    assert exact_groups(empty).count() == drop_exact_copies(empty).count() == 0
    assert near_classes(empty).count() == drop_near_copies(empty).count() == 0


def shingled(body):
    words = (body or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows):
    bags = {r[0]: shingled(r[1]) for r in rows if r[0] is not None}
    lead = {n: n for n in bags}

    def top(n):
        while lead[n] != n:
            n = lead[n]
        return n

    for a in bags:
        for b in bags:
            both = sum((bags[a] & bags[b]).values())
            if a < b and (5 * both >= 4 * (sum(bags[a].values()) + sum(bags[b].values()) - both)):
                one, other = sorted((top(a), top(b)))
                lead[other] = one
    return {n: top(n) for n in bags}


def edited(seed, at):
    words = text(seed, 120).split()
    words[at] = f"edit{at}"
    return " ".join(words)


def test_near_classes_agree_with_brute_force(spark):
    rows = [row(1000 + n, text(n, 60 + n)) for n in range(30)]
    rows += [row(100 + n, edited(500, n)) for n in range(60)]
    rows += [row(200 + n, text(900, 40) + " " + text(1000 + n, 30)) for n in range(25)]  # a shared passage only
    rows += [row(300, " ".join(["again and again we go"] * 40)), row(301, " ".join(["again and again we go"] * 60))]
    rows += awkward()
    got = near_classes(clashing(frame(spark, rows)))
    classes = {r.doc_id: r.class_id for r in got.collect() if r.doc_id is not None}
    assert classes == brute_classes(rows)
    assert got.count() == len(rows)
    assert len({classes[100 + n] for n in range(60)}) == 1
    assert len({classes[200 + n] for n in range(25)}) == 25


def test_links_between_members_that_the_lead_does_not_match(spark, monkeypatch):
    """A bucket led by a text like neither of two that are alike: the blocks find the link."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    texts = spark.createDataFrame([(n, [7, 100 + n]) for n in range(1, 6)], "_text_id long, _bands array<long>")
    same = text(1, 100)
    bodies = {1: text(50, 100), 2: same, 3: same + " more", 4: text(60, 100), 5: same + " less"}
    known = spark.createDataFrame(list(bodies.items()), "_id long, _text string")
    members = spark.createDataFrame([(7, n, 5, 1) for n in range(1, 6)], "_bucket long, _id long, _members long, _lead long")
    none = spark.createDataFrame([], "_node long, _class long")
    pairs = near_dedup.contested(members, none, texts, known, 0.8)
    assert sorted(map(tuple, pairs.collect())) == [(2, 3), (2, 5), (3, 5)]


def test_near_copies_are_dropped(spark):
    docs = clashing(frame(spark, awkward() + [row(20, edited(5, 3)), row(21, edited(5, 9))]))
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[None] == 2 and ids[5] == 1 and ids[20] == 1 and ids[21] == 0 and ids[1] == 1 and ids[2] == 0


def test_texts_of_one_identifier_are_told_apart(spark):
    rows = [row(1, text("A", 90)), row(1, text("B", 90)), row(2, text("B", 90) + " x"), row(3, text("C", 90))]
    rows += [row(4, text("D", 90)), row(4, text("D", 90)), row(4, text("E", 90)), row(5, text("E", 90) + " x")]
    left = drop_near_copies(clashing(frame(spark, rows)))
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((r[0], r[1]) for r in [*rows[:2], rows[3], *rows[4:7:2]])
    got = near_classes(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in got) == [
        (1, 1, 1, True), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True),
        (4, 4, 2, False), (4, 4, 2, True), (4, 4, 2, True), (5, 4, 2, False),
    ]


@pytest.mark.parametrize("grow", [1, 3])
def test_bag_min_hash_estimates_multiset_overlap(grow):
    rng = np.random.default_rng(grow)
    one = [f"w{i}" for i in rng.integers(0, 60, 300)]
    other = one[30 * grow :] + [f"x{i}" for i in range(20)]
    a, b = hash_words(pa.array(one)), hash_words(pa.array(other))
    found = bag_min_hash(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 4000)
    exact = overlap(np.unique(a, return_counts=True), np.unique(b, return_counts=True))
    assert abs((found[0] == found[1]).mean() - exact) < 0.035


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(1, 40)] + [(100, 101)], "_lead long, _id long")
    got = dict(components(links).collect())
    assert got == {n: 1 for n in range(1, 41)} | {100: 100, 101: 100}


def test_candidates_stay_linear_in_a_group_of_copies(spark):
    rows = [row(n, edited(3, n % 100) + f" tail{n}") for n in range(400)]
    got = near_classes(spark.createDataFrame(rows, DOCS))
    assert got.agg(F.countDistinct("class_id")).first()[0] == 1
