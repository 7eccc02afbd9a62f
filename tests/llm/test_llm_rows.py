"""Rows with repeated and missing ids: nothing is lost that has no twin, and rows are judged by their own texts."""

import random
import re

import pytest

from corpusmix.llm import decontaminate, minhash

SCHEMA = "doc_id bigint, text string, _id string, _key string, _leaks string"
WORDS = [f"w{n}" for n in range(400)]


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def table(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c") for row in rows], SCHEMA).repartition(3)


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    size = min(len(words), 5)
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def linked(a, b):
    one, other = shingles(a), shingles(b)
    return bool(one) and 100 * len(one & other) >= 80 * len(one | other)


def test_a_text_in_two_documents_of_several_rows_stays(spark):
    x, y = prose(1), prose(2)
    kept = minhash.drop_near_duplicates(table(spark, [(5, x), (5, y), (3, y), (9, x)]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, y), (5, x)]
    assert kept.columns == ["doc_id", "text", "_id", "_key", "_leaks"]


def test_rows_of_one_document_are_one_node(spark):
    x, y = prose(1), prose(2)
    found = minhash.near_duplicates(table(spark, [(5, x), (5, y), (3, y), (9, x), (7, prose(3)), (5, None)]))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(5, 3), (3, 3), (9, 3), (7, 7)}
    assert {r["doc_id"] for r in found.collect() if r["kept"]} == {3, 7}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_that_goes_has_a_linked_twin_that_stays(spark, seed):
    rng = random.Random(seed)
    bases = [prose(100 * seed + n) for n in range(6)]
    rows = []
    for _ in range(150):
        words = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 0, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        text = rng.choice([" ".join(words), " ".join(words), " ".join(words), None, "", " \n"])
        rows.append((rng.choice([None, *range(25)]), text))
    kept = [(r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(table(spark, rows)).collect()]
    # Groups by brute force over all rows with words.
    worded = sorted({row for row in rows if shingles(row[1])}, key=repr)
    group = {row: row for row in worded}

    def find(row):
        return row if group[row] == row else find(group[row])

    for a in worded:
        for b in worded:
            if a < b if None not in (a[0], b[0]) else repr(a) < repr(b):
                if linked(a[1], b[1]) and find(a) != find(b):
                    group[find(a)] = find(b)
    members = {}
    for row in worded:
        members.setdefault(find(row), []).append(row)
    assert sorted(repr(find(row)) for row in kept if shingles(row[1])) == sorted(map(repr, members))
    for rows_of in members.values():
        (stays,) = [row for row in rows_of if row in kept]
        assert (stays[0] is None, stays[0] or 0) == min((d is None, d or 0) for d, _ in rows_of)
    assert sum(not shingles(t) for _, t in kept) == sum(not shingles(t) for _, t in rows)


def test_an_empty_table_and_many_equal_rows(spark):
    assert minhash.drop_near_duplicates(table(spark, [(1, "a b")]).limit(0)).collect() == []
    same = table(spark, [(4, prose(1))] * 50 + [(None, prose(1))] * 50 + [(None, prose(2))] * 3)
    assert sorted((r["doc_id"] or 0) for r in minhash.drop_near_duplicates(same).collect()) == [0, 4]


def test_many_copies_with_edits_that_many_share(spark):
    """A large bucket of sets that are linked with none or few, whose edits come again in others."""
    rng = random.Random(4)
    base = [f"b{n}" for n in range(100)]
    rows = []
    for n in range(250):
        words = list(base)
        for at in rng.sample(range(100), rng.randint(2, 5)):
            words[at] = f"edit{rng.randrange(4)}"
        rows.append((n, " ".join(words)))
    root = {n: n for n, _ in rows}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, one in rows:
        for b, other in rows:
            if a < b and linked(one, other):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = minhash.near_duplicates(table(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {n: find(n) for n, _ in rows}


def test_leaks_are_judged_row_by_row(spark):
    passage = prose(7, 40)
    items = [(1, passage), (2, "short one here"), (3, "another bit x"), (None, prose(8, 40))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = prose(9)
    rows = [(None, clean), (None, f"{clean} {passage}"), (None, f"{clean} short one here"), (None, f"another bit x {clean}")]
    rows += [(5, clean), (5, f"{passage} {clean}"), (6, f"short one here {clean} another bit x"), (7, None), (8, "")]
    kept = decontaminate.without_leaks(table(spark, rows), bench)
    assert kept.columns == ["doc_id", "text", "_id", "_key", "_leaks"]
    left = [rows[0], rows[2], rows[3], rows[4], rows[7], rows[8]]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(repr, left))
    assert decontaminate.without_leaks(table(spark, rows), bench.limit(0)).count() == len(rows)
    assert decontaminate.without_leaks(table(spark, rows).limit(0), bench).count() == 0
