"""Each operator on a small table of odd cases, against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmix.llm import bpe, chat, decontaminate, language, minhash, pii, quality, repeats, token_files, url_rules
from corpusmix.llm.queries import URL_RULES
from corpusmix.session import stage_path

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, spans string"
WORDS = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "in") for b in ("ing", "ed", "tion", "ly", "", "s")]


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


BASE = prose(1, 120)
TEXTS = [
    None, "", " \n\t ", "é", BASE, BASE, BASE.replace("ing", "xx", 1), prose(2, 60) + " " + BASE[:300],
    prose(3, 3000), "a" * 9000, "Ünḯ ÇODE İΣ ok's 12 ١٢ !!'s", "<|endoftext|> and <|startof", prose(4, 15) + "\nx\nx",
    "ab " * 200, prose(5, 40) + " 中文字符 " * 9,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, None if k == 3 else ("en", "de")[k % 2], None if k % 4 == 0 else f"s{k % 3}", 1, "x", "y") for k, t in enumerate(TEXTS)]
    rows += [(2, TEXTS[2], "en", "s0", 1, "x", "y"), (None, BASE, "en", "s1", 1, "x", "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pairs(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_tokens_equal_the_library(spark, docs, library):
    expected = []
    for doc_id, text in pairs(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, back))
    assert Counter(map(tuple, bpe.round_trip(docs, PATH).collect())) == Counter(expected)
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
    encoded = bpe.encode(docs.where("doc_id = 4"), PATH)
    assert bpe.decode(encoded, PATH).first()["text"].split() == BASE.lower().split()


def test_both_ways_to_merge_agree():
    merges = bpe.load_merges(PATH)
    rng = random.Random(11)
    for _ in range(400):
        symbols = [rng.choice("aaeinorstth") for _ in range(rng.randint(1, 60))]
        symbols[-1] += merges.end
        assert merges._merge_short(symbols) == merges._merge_long(symbols) == merges.merge(symbols)


def test_streaming_in_any_pieces(library):
    merges, rng = bpe.load_merges(PATH), random.Random(5)
    for text in [t for t in TEXTS if t and len(t) < 10_000]:
        stream, out, at = bpe.StreamEncoder(merges), [], 0
        while at < len(text):
            step = rng.randint(1, 700)
            out += stream.feed(text[at : at + step])
            assert len(stream.window) <= 2 * merges.lookahead + 4 * bpe.WINDOW_STEP
            at += step
        assert out + stream.finish() == library.encode(text, add_special_tokens=False).ids
    decoder = bpe.StreamDecoder(merges, "text")
    ids = library.encode("zürich 中", add_special_tokens=False).ids
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "zürich 中 "


def test_token_files(spark, docs, library):
    path = stage_path(spark, "test_tokens")
    token_files.write_token_files(docs, path, PATH, 1)
    found = sorted(map(tuple, token_files.read_documents(spark, path).collect()), key=lambda r: r[1])
    ordered = sorted(pairs(docs), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    start = 0
    for (doc_id, text), row in zip(ordered, found, strict=True):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert row == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    empty = stage_path(spark, "test_no_tokens")
    token_files.write_token_files(docs.limit(0), empty, PATH, 1)
    assert token_files.read_documents(spark, empty).count() == 0


def test_words_of_many_ids():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 16, 33, 60, 61, 64):
        ids = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) >> np.uint64(max(0, 63 - bits))
        ids[::97] = np.uint64((1 << bits) - 1)
        words, starts = token_files.pack(ids)
        assert (token_files.unpack(words) == ids).all()
        assert (token_files.unpack_range(words, starts, 2000, 4100) == ids[2000:4100]).all()
    assert len(token_files.pack(np.zeros(0, np.uint64))[0]) == 0


def test_repeats_equal_brute_force(spark, docs, monkeypatch):
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    hidden = spark.createDataFrame([(100 + k, prose(9, 30) + f" {k} " + prose(10, 4)) for k in range(6)], "doc_id bigint, text string")
    table = unique.select("doc_id", "text").unionByName(hidden)
    seen, expected = set(), {}
    for doc_id, text in sorted(pairs(table)):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            part = data[at : at + 100]
            if part in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        expected[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    for bucket in (repeats.BUCKET, 3, 1):  # by suffix arrays, after some splits, and by splits down to single strings
        monkeypatch.setattr(repeats, "BUCKET", bucket)
        found = {r[0]: tuple(r[1:]) for r in repeats.remove_repeats(table).collect()}
        assert found == expected
    assert repeats.remove_repeats(docs).count() == docs.count()
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_repeats_in_repeated_rows(spark, monkeypatch):
    one, two, three = (prose(k, 30) for k in (61, 62, 63))
    rows = [(1, one)] * 3 + [(2, one[:150] + two)] * 2 + [(3, two[:110] + three), (3, three + two), (3, one[:120]), (4, three[20:])]
    rows += [(6, prose(64, 30)), (6, "zz " + prose(64, 30)), (None, prose(65, 30)), (None, prose(65, 30) + " zz"), (None, None), (None, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    order = {
        (r["doc_id"], r["text"]): (r["doc_id"] is not None, r["doc_id"] or 0, r["digest"])
        for r in table.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS digest").collect()
    }
    first, gone = {}, {}
    for row in rows:
        text = row[1] or ""
        for at in range(len(text) - 99):
            part = text[at : at + 100]
            first[part] = min(first.get(part, (order[row], at)), (order[row], at))
    for row in rows:
        text = row[1] or ""
        for at in range(len(text) - 99):
            if first[text[at : at + 100]] != (order[row], at):
                gone.setdefault(row, set()).update(range(at, at + 100))
    expected = []
    for row in rows:
        text = row[1] or ""
        kept = "".join(c for k, c in enumerate(text) if k not in gone.get(row, ()))
        expected.append((row[0] or -1, len(text), len(text) - len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    assert (1, one) not in gone
    whole = {row for row in rows if row not in gone}
    assert any(row[0] == 6 for row in whole) and any(row[0] is None and row[1] for row in whole)
    for bucket in (repeats.BUCKET, 1):
        monkeypatch.setattr(repeats, "BUCKET", bucket)
        made = repeats.remove_repeats(table).selectExpr("coalesce(doc_id, -1)", "n_bytes", "n_removed", "kept_sha256")
        assert sorted(map(tuple, made.collect())) == sorted(expected)


def test_pieces_hold_every_string_once():
    rng = np.random.default_rng(5)
    for _ in range(300):
        core = int(rng.choice([32, 66, 83, 92, 96, 98, 99]))
        count = int(rng.integers(1, 102 - core))
        low, high = max(0, count - 1), 100 - core  # the core lies in every string
        at = int(rng.integers(low, high + 1))
        part = rng.integers(0, 256, count + 99, dtype=np.uint8).tobytes()
        grown = core + (101 - core) // 2
        strings = []
        for first, past, place in repeats._pieces(part, at, core):
            for start in range(first, past - 99):
                strings.append(start)
                assert start <= place and place + grown <= start + 100
        assert strings == list(range(count))


def test_suffix_array():
    parts = [b"banana", b"ananas", b"", b"banana", bytes(range(256))]
    owner, length, common = repeats.suffix_array(parts)
    suffixes = [parts[o][len(parts[o]) - n :] for o, n in zip(owner.tolist(), length.tolist())]
    assert len(suffixes) == sum(len(p) + 1 for p in parts) and suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], common[1:].tolist()):
        assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1] or n == min(len(a), len(b))


def test_suffix_array_of_parts_with_cores():
    rng = random.Random(8)
    for size in (1, 2, 5, 9):
        known = [bytes(rng.choices(b"ab", k=size)) for _ in range(3)]
        cores = [rng.randrange(3) for _ in range(60)]
        cores = [known.index(known[core]) for core in cores]
        at = [rng.randrange(5) for _ in cores]
        parts = [bytes(rng.choices(b"ab", k=k)) + known[c] + bytes(rng.choices(b"ab", k=rng.randrange(5))) for k, c in zip(at, cores)]
        owner, length, common = (x.tolist() for x in repeats.suffix_array(parts, at, cores, size))
        starts = [len(parts[o]) - n for o, n in zip(owner, length)]
        outside = [(k, b) for k, part in enumerate(parts) for b in range(len(part) + 1) if not at[k] < b < at[k] + size]
        assert sorted(zip(owner, starts)) == outside

        def symbols(k):  # of the suffix, with its core as one symbol of its length
            part, here = parts[owner[k]], at[owner[k]]
            if starts[k] > here:
                return [(x, 1) for x in part[starts[k] :]]
            head, tail = part[starts[k] : here], part[here + size :]
            return [(x, 1) for x in head] + [(256 + cores[owner[k]], size)] + [(x, 1) for x in tail]

        rows = [symbols(k) for k in range(len(owner))]
        assert rows == sorted(rows)
        for before, row, n in zip(rows, rows[1:], common[1:]):
            same = 0
            while same < min(len(before), len(row)) and before[same] == row[same]:
                same += 1
            assert n == sum(weight for _, weight in row[:same])


def test_columns_of_a_bucket_are_the_bytes_beside_the_cores(monkeypatch):
    rng = np.random.default_rng(6)
    core = rng.integers(0, 256, 83, dtype=np.uint8).tobytes()
    sides = [rng.integers(0, 256, 17, dtype=np.uint8).tobytes() for _ in range(3)]
    bucket = [(1, k, 0, 0, sides[k] + core + sides[2]) for k in range(2)]
    bucket.append((1, 2, 0, 50, sides[0] + core + sides[2][:5]))
    rounds = []
    argsort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **b: rounds.append(1) or argsort(*a, **b))
    # The second has the last string of the first, the third its first six.
    found = sorted(repeats._earlier(bucket, [17, 17, 17], 66))
    monkeypatch.undo()
    gone = {(k, b) for k, _, first, past in found for b in range(first, past)}
    assert gone == {(1, b) for b in range(17, 117)} | {(2, b) for b in range(50, 155)}
    assert len(rounds) < 50  # a round per byte would be 117


def test_cut_pieces_fill_batches_over_documents(monkeypatch):
    texts = [prose(70 + k, 9) for k in range(7)]
    # (first string, place of the anchor in it, strings)
    wanted = [[], [(0, 68, 1)], [(3, 40, 2), (9, 10, 3)], [], [(0, 0, 1)], [(5, 60, 9)] * 4, []]
    spans = pa.array(
        [[{"start": a, "shape": b << 8 | c} for a, b, c in row] for row in wanted], pa.list_(pa.struct([("start", pa.int64()), ("shape", pa.int32())]))
    )
    columns = [pa.array(range(7), pa.int64()), pa.array([0] * 7, pa.int64()), pa.array(texts), spans]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "text", "wanted"])
    expected = [
        (k, a + low, texts[k].encode()[a + low : a + past])
        for k, row in enumerate(wanted)
        for a, b, c in row
        for low, past, _ in repeats._pieces(texts[k].encode()[a : a + c + 99], b, 32)
    ]
    for parts, count in ((repeats.PARTS, 1), (3, 3)):
        monkeypatch.setattr(repeats, "PARTS", parts)
        made = list(repeats._cut(iter([batch.slice(0, 3), batch.slice(3)])))
        found = [(r["doc_id"], r["start"], r["bytes"]) for one in made for r in one.to_pylist()]
        assert found == expected and len(made) == count


def test_near_duplicates_equal_brute_force(spark, docs):
    rng = random.Random(3)
    near = []
    for k in range(60):
        words = BASE.split()
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        near.append((200 + k, " ".join(words)))
    for k in range(120):  # most of these are linked with few or none
        words = BASE.split()
        for at in rng.sample(range(len(words)), rng.randint(4, 14)):
            words[at] = f"new{rng.randrange(3)}" if at % 3 else f"own{rng.random()}"
        near.append((400 + k, " ".join(words)))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id bigint, text string"))
    sets = {}
    for doc_id, text in pairs(table):
        if doc_id is not None:
            words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
            sets[doc_id] = set(zip(words, words[1:])) if len(words) > 1 else ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(d):
        return d if root[d] == d else find(root[d])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = minhash.near_duplicates(table, words=2).collect()
    assert len(found) == table.count()
    for row in found:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            d = row["doc_id"]
            assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[d]), find(d), find(d) == d)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_differences_bound_linked_sets():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 100)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(85, 101)], rng.integers(0, 1 << 62, 8)])) for _ in range(40)]
    known, counts = np.unique(np.concatenate(sets[:9]), return_counts=True)
    mixed = rng.permutation(len(known))
    firsts = [minhash.difference(s, known[mixed], counts[mixed], 9).tolist() for s in sets]
    for a, one in zip(sets, firsts):
        for b, other in zip(sets, firsts):
            assert len(np.setxor1d(a, b)) == len(one) + len(other) - 2 * len(set(one) & set(other))
            need = -int(-(180 * (len(one) + len(other)) - 20 * (len(a) + len(b))) // 360)
            shared = len(np.intersect1d(a, b))
            if need > 0 and 100 * shared >= 80 * (len(a) + len(b) - shared):
                assert set(one[: len(one) - need + 1]) & set(other[: len(other) - need + 1])
            assert [x for x in one if x in set(other)] == [x for x in other if x in set(one)]
    assert minhash.difference(base, known[:0], counts[:0], 0).tolist() == sorted(base.tolist())


def test_sketches_fill_and_agree_like_the_sets():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    sets = [base, np.concatenate([base[:900], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]), base[:1], base[:0]]
    table = minhash.sketches([np.unique(s) for s in sets])
    full = np.iinfo(np.uint64).max
    assert (table[:3] != full).all() and (table[3] == full).all()
    assert abs((table[0] == table[1]).mean() - 900 / 1100) < 0.15


def test_decontamination(spark, docs):
    item = prose(77, 40)
    edited = item.replace("tion", "tiom", 2)
    bench = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, "")], "item_id bigint, text string")
    bad = [(300, prose(8, 30) + " " + item.upper() + " " + prose(9, 30)), (301, edited), (302, prose(6, 9) + "\n" + item[20:150])]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(bad, "doc_id bigint, text string"))
    found = decontaminate.find_leaks(table, bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(300, 1), (301, 1), (302, 1)}
    assert decontaminate.without_leaks(table, bench).count() == docs.count()
    assert decontaminate.find_leaks(table, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_excerpts_of_long_items_and_bare_phrases(spark):
    item = prose(78, 60)[:300]
    bench = spark.createDataFrame([(1, item), (2, "thank you a lot"), (3, "with kind regards"), (4, prose(79, 40)[:67])], "item_id bigint, text string")
    spread = list(prose(79, 40)[:67])
    for at in (18, 28, 38, 48):  # four edits that every part of 50 characters has
        spread[at] = "#"
    texts = {10 + size: prose(80 + size, 20) + " " + item[100 : 100 + size] + " " + prose(90 + size, 20) for size in (40, 60, 75, 90)}
    texts |= {1: "so thank you a lot and thank you a lot", 2: "thank you a lot, with kind regards", 3: "".join(spread), 4: "x" * 400}
    texts |= {5: prose(97, 20) + item[100:120] + "#" + item[121:135] + "#" + item[136:165] + prose(98, 20)}
    table = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(table, bench).collect()}
    assert found == {(70, 1), (85, 1), (100, 1), (1, 2), (2, 2), (2, 3), (3, 4), (5, 1)}
    assert {r["doc_id"] for r in decontaminate.without_leaks(table, bench).collect()} == {50, 1, 4}


def test_benchmark_rows_without_ids(spark):
    bench = spark.createDataFrame([(None, prose(70, 20)), (1, prose(71, 20)), (None, prose(72, 20)), (None, None)], "item_id bigint, text string")
    table = spark.createDataFrame([(k, prose(70 + k, 20)) for k in range(4)] + [(None, prose(71, 20))], "doc_id bigint, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(table, bench).collect()]
    assert sorted(found, key=str) == sorted([(0, None), (1, 1), (2, None), (None, 1)], key=str)
    assert [r["doc_id"] for r in decontaminate.without_leaks(table, bench).collect()] == [3]


def every_hit(items, text):
    """All equal q-grams of items and a text, pair by pair: item, place in the document, diagonal."""
    q = decontaminate.Q
    return {(k, a, a - p) for k, item in enumerate(items) for p in range(len(item) - q + 1) for a in range(len(text) - q + 1) if item[p : p + q] == text[a : a + q]}


def windows_by_brute_force(items, text):
    """Items that have a window which shares enough q-grams with a part of the text, in a band of diagonals, and has few edits."""
    hits = every_hit(items, text)
    out = set()
    for k, item in enumerate(items):
        for window, edits, needed in decontaminate.budgets(len(item)):
            for p in range(len(item) - window + 1):
                inside = [d for i, a, d in hits if i == k and p <= a - d <= p + window - decontaminate.Q]
                for low in sorted(set(inside)):
                    if k not in out and sum(low <= d <= low + edits for d in inside) >= needed:
                        part = decontaminate._codes(item[p : p + window])
                        if decontaminate.aligned_edits(part, decontaminate._codes(text), low + p - edits, low + p + 2 * edits) <= edits:
                            out.add(k)
    return out


def test_stretches_hold_every_hit_and_find_what_brute_force_finds():
    rng = random.Random(12)
    for _ in range(15):
        letters = rng.choice(["ab", "abc", "abcdefghij"])
        items = ["".join(rng.choice(letters) for _ in range(rng.randint(10, 70))) for _ in range(3)] + ["xy" * 20]
        parts = [rng.choice(items) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 4))]
        text = list("q".join(parts))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(["", "z", "a"])
        text = "".join(text)
        index = decontaminate.Index.build(list(enumerate(items)))
        found = [(i, a, d) for i, d, s, e in zip(*map(np.ndarray.tolist, index.stretches(decontaminate._codes(text)))) for a in range(s, e + 1)]
        assert len(found) == len(set(found)) and set(found) == every_hit(items, text)
        assert {region[0] for region in decontaminate.passages(index, text)} == windows_by_brute_force(items, text)


def test_long_lines_of_one_character_take_little():
    index = decontaminate.Index.build([(1, "=" * 5_000), (2, "=-" * 2_000)])
    tracemalloc.start()
    started = time.monotonic()
    found = list(decontaminate.passages(index, "=" * 20_000 + "x" + "-=" * 3_000))
    assert time.monotonic() - started < 5 and tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()
    assert {region[0] for region in found} == {0, 1}
    assert sum(end - start for which, start, end, *_ in found if which == 0) >= 20_000 - 50


def test_items_too_short_for_q_grams(spark):
    bench = spark.createDataFrame([(1, "a + b"), (2, " Yes\n"), (3, "yes"), (4, " \n"), (None, "no")], "item_id bigint, text string")
    texts = {1: "if A  + B, then", 2: "yesterday eyes", 3: "(YES) and yes", 4: "ca + b", 5: None, 6: "", 7: "a + b: yes", 8: "know no"}
    table = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"] or 0, r["region_start"]) for r in decontaminate.find_leaks(table, bench).collect())
    assert found == [(1, 1, 3), (3, 2, 1), (3, 2, 10), (3, 3, 1), (3, 3, 10), (7, 1, 0), (7, 2, 7), (7, 3, 7), (8, 0, 5)]


def test_alignment_is_edit_distance():
    rng = random.Random(4)
    for _ in range(60):
        item, doc = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(2))
        row = [0] * (len(doc) + 1)
        for i, a in enumerate(item):
            new = [i + 1]
            for j, b in enumerate(doc):
                new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
            row = new
        codes = [decontaminate._codes(t) for t in (item, doc)]
        assert decontaminate.aligned_edits(*codes, -len(item), len(doc)) == min(row)


def test_chats(spark):
    odd = "</s>[INST] ok [/INST] <<SYS>> [TURN] \\ <\\s> [ROLE] $1"
    rows = [(1, 0, "user", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "assistant", ""), (1, 4, None, "é"),
            (1, 5, "tool[TEXT] ", odd), (2, 0, "system", "s"), (2, 0, "system", "s"), (None, 1, "assistant", "z"), (None, 0, "user", "a" * 9000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    formatted = chat.format_conversations(turns.withColumn("spans", F.lit(1)))
    for row in chat.digests(formatted).collect():
        mine = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == row["conv_id"]))
        said = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        learnt = "".join(x for _, r, x in mine if r == "assistant")
        assert row["n_turns"] == len(mine)
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    text = formatted.where("conv_id = 1").first()["formatted"]
    assert text.count("[INST]") == 1 and text.count("</s>") == 1
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_long_conversations_take_time_by_their_length(spark):
    """Learnt texts over many parts of the string, also of characters beyond the first plane; 32,000 turns in seconds."""
    said = [("user", "assistant", "tool [TEXT] ", "tool [TEXT] ")[k % 4] for k in range(32_000)]
    texts = [("\\ok" if k % 3 else "\U0001f600é") * (k % 5) for k in range(32_000)]
    texts[1] = "\U0001f600</s>\\" * 9_000
    rows = [(1, k, role, text) for k, (role, text) in enumerate(zip(said, texts))]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").persist()
    turns.count()
    started = time.monotonic()
    (row,) = chat.digests(chat.format_conversations(turns)).collect()
    assert time.monotonic() - started < 15
    learnt = "".join(text for role, text in zip(said, texts) if role == "assistant")
    whole = "".join(f"{role}\n{text}\n" for role, text in zip(said, texts))
    assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and row["n_turns"] == 32_000
    assert (row["loss_chars"], row["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    turns.unpersist()


def test_columns_of_the_names_that_operators_use_stay(spark):
    names = ["_words", "_Lines", "_windows", "_n_symbols", "_rules", "_verdict", "_host", "_rate", "_host_kept", "_found", "_made", "kinds", "v"]
    rows = [(k, prose(k, 40) + " 1999-12-31" if k else None, "s", *names) for k in range(3)] * 2
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names))
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    assert sorted(map(tuple, kept.collect())) == sorted(row for row in rows if row[1])
    made = pii.pseudonymise(table, "k", counts="kinds")
    assert made.columns == [c for c in table.columns if c != "kinds"] + ["kinds"]
    for row in made.collect():
        assert [row[n] for n in names if n != "kinds"] == [n for n in names if n != "kinds"]
        assert (row["text"] is None) == (row["doc_id"] == 0) and row["kinds"]["date"] == (row["doc_id"] > 0)
    assert pii.pseudonymise(table.limit(0), "k").collect() == []


def test_quality_equals_brute_force(spark, docs):
    judged = quality.judge_ruled(quality.with_rules(docs)).collect()
    assert len(judged) == docs.count()
    for row in judged:
        text, verdict = row["text"] or "", row["_verdict"]
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        times = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
        lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        counts = (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert counts == tuple(verdict)[:5] and verdict["base_failed"] == failed and not (failed and verdict["kept"])
    assert set(quality.keep_good(docs).columns) == set(docs.columns)
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_one_bad_document_does_not_condemn_a_host(spark):
    rows = [(k, prose(k, 40), "good") for k in range(30)] + [(100, "x", "good"), (101, "x", "tiny")]
    rows += [(200 + k, "x", "bad") for k in range(40)] + [(300, prose(300, 40), "bad")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    verdicts = {r["host"]: r for r in quality.host_verdicts(quality.with_rules(table)).collect()}
    assert verdicts["good"]["host_kept"] and not verdicts["bad"]["host_kept"]
    assert verdicts["tiny"]["rate"] < 1
    assert quality.keep_good(table).count() == 30


def test_url_rules(spark):
    urls = {1: "https://A.Example.ORG/es/1", 2: "http://x.org/q?z", 3: "http://x.org", 4: None, 5: "no scheme", 6: "http://b.com/de/1#f",
            7: "http://b.com/xx", 8: "http://example.org/en/12", 9: "http://links.net/a", 10: ""}
    html = {9: '<a href="//b.com/q">x</a> <a href="http://b.com/r">y</a> <a href="/self">', 4: None}
    pages = spark.createDataFrame([(k, u, html.get(k, "")) for k, u in urls.items()], "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in url_rules.judge_pages(pages, URL_RULES).collect()}
    assert (found[1]["host"], found[1]["path"], found[1]["rule"], found[1]["verdict"]) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (found[2]["rule"], found[2]["verdict"], found[3]["rule"], found[3]["path"]) == ("org/", "allow", None, "")
    assert (found[4]["host"], found[5]["host"], found[10]["verdict"]) == ("", "", "allow")
    assert (found[6]["rule"], found[7]["rule"], found[7]["verdict"]) == ("com/de/", None, "block")
    assert found[8]["rule"] == "example.org/en/1" and found[9]["verdict"] == "block"  # it links to blocked pages only
    assert url_rules.judge_pages(pages.limit(0), URL_RULES).count() == 0


def test_distrust_reaches_the_end_of_a_chain(spark):
    # Each host links to the one before it; the first is blocked. A ring of two links to both kinds.
    links = {k: [f"h{k - 1}.net"] for k in range(1, 15)} | {20: ["h21.net", "a.org"], 21: ["h20.net", "b.com"]}
    pages = [(k, f"http://h{k}.net/", "".join(f'<a href="http://{h}/">' for h in to)) for k, to in links.items()]
    pages += [(100, "http://h0.net/", ""), (101, "http://a.org/", '<a href="http://h20.net/">'), (102, "http://b.com/de/1", "")]
    rules = (*URL_RULES, url_rules.Rule("block", "h0.net", "/"))
    made = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r["page_id"]: r for r in url_rules.judge_pages(made, rules).collect()}
    assert {(found[k]["verdict"], found[k]["distrust_share"]) for k in range(1, 15)} == {("block", 1.0)}
    # The ring against the linear equations it has to meet.
    hosts = ["h20.net", "h21.net", "a.org", "b.com"]
    edges = [(0, 1), (0, 2), (1, 0), (1, 3), (2, 0)]
    count_out, count_in = Counter(e[0] for e in edges), Counter(e[1] for e in edges)
    forward, backward = np.zeros((4, 4)), np.zeros((4, 4))
    for a, b in edges:
        forward[b, a], backward[a, b] = 1 / count_out[a], 1 / count_in[b]
    trust = np.linalg.solve(np.eye(4) - 0.85 * forward, 0.15 * np.array([0, 0, 1, 0]))
    distrust = np.linalg.solve(np.eye(4) - 0.85 * backward, 0.15 * np.array([0, 0, 0, 1]))
    for k, host in enumerate(hosts):
        shares = {r["distrust_share"] for r in found.values() if r["host"] == host}
        assert shares and all(abs(v - distrust[k] / (trust[k] + distrust[k])) < 1e-6 for v in shares)


def test_pseudonyms_stay_in_their_format(spark):
    values = ["4111111111111111", "4111 1111 1111 1111", "+1 (017) 555-7713", "97.51.17.173", "1999-12-31", "31/12/1999", "123-45-6789"]
    left = ["4111111111111112", "256.1.1.1", "1999-02-31", "000-12-1234", "1.2.3", "12345"]
    rows = [(k, f"see {v}. and {v}, x@y.example.com", "t") for k, v in enumerate(values)] + [(50 + k, f"see {v}.", "t") for k, v in enumerate(left)]
    rows += [(98, None, "t"), (99, "", "t"), (97, 'token = "' + "0a" * 20 + '" ' + "b" * 90_000, "t")]
    made = pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string, kind string"), "k")
    found = {r["doc_id"]: r["text"] for r in made.collect()}
    for k, value in enumerate(values):
        one, two = re.fullmatch(r"see (.+)\. and (.+), u\w+@m\w+\.example", found[k]).groups()
        assert one == two != value and re.sub(r"\d", "9", one) == re.sub(r"\d", "9", value) or "." in value
    assert [found[50 + k] for k in range(len(left))] == [f"see {v}." for v in left]
    assert found[98] is None and found[99] == "" and "0a0a" not in found[97]
    numbers = spark.range(189 * 773).select(F.expr(pii.feistel("id", 189, 773, "k", "t")).alias("p"), "id")
    back = numbers.where(F.expr(pii.feistel("p", 189, 773, "k", "t", True)) != F.col("id"))
    assert numbers.select("p").distinct().count() == 189 * 773 and back.count() == 0


def test_pseudonyms_of_more_forms(spark):
    numbers = ["555-123-4567", "555.123.4567", "555 123 4567", "1-800-555-0199", "+1 555 123 4567", "+15551234567", "(555) 123-4567",
               "+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+49 (30) 1234567", "+354 555 1234", "+7 495 123-45-67"]
    others = ["12/31/1999", "02/29/2000", "3782 822463 10005", "3782-822463-10005", "3056 930902 5904"]
    secrets = [f"{k}{gap}{q}{blank}%s{blank}{q}" for k, gap, q, blank in (("token", "=", '"', ""), ("API_KEY", " : ", "'", ""), ("Password", "  =  ", '"', " "), ('"secret"', ": ", '"', ""))]
    values = numbers + others
    left = ["02/30/2000", "13/13/1999", "12/31/1650", "3782 822463 10006", "155-123-4567", "555-123-45678", "12-555-123-4567", "+83 20 7946 0958",
            "+1 055 123 4567", "+44 1234", "4.555.123.4567", 'tokens "%s"' % ("0A" * 20), 'token = "%s' % ("0a" * 20)]
    rows = [(k, f"see {v}, and {v}.") for k, v in enumerate(values)] + [(50 + k, f"see {v}, x") for k, v in enumerate(left)]
    rows += [(80 + k, v % ("0A" * 20)) for k, v in enumerate(secrets)]
    found = {r["doc_id"]: r["text"] for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()}
    made = []
    for k, value in enumerate(values):
        one, two = re.fullmatch(r"see (.+), and (.+)\.", found[k]).groups()
        assert one == two != value and re.sub(r"\d", "9", one) == re.sub(r"\d", "9", value), value
        made.append(one)
    assert [found[50 + k] for k in range(len(left))] == [f"see {v}, x" for v in left]
    digits = [re.sub(r"\D", "", v.replace("(0)", "")) for v in made]
    assert len({v[-10:] for v in digits[:3] + digits[4:7]}) == 1 and len(set(digits[7:10])) == 1  # one number, one pseudonym
    assert [v[:2] for v in digits[7:11]] == ["44", "44", "44", "49"] and "(0)" in made[9]
    for k, value in enumerate(secrets):
        assert re.fullmatch(re.escape(value).replace("%s", "[0-9A-F]{40}"), found[80 + k]) and "0A0A" not in found[80 + k]
    kinds = ["phone"] * len(numbers) + ["date"] * 2 + ["card"] * 3
    back = spark.createDataFrame(list(zip(kinds, made, values)), "kind string, v string, value string")
    assert [r["b"] for r in back.select(F.expr(pii.pseudonym("k", invert=True)).alias("b")).collect()] == values
    again = back.select("v", F.expr(pii.KIND).alias("found"), "kind").where("NOT found <=> kind")
    assert again.count() == 0


def test_month_first_dates_are_permuted_among_themselves(spark):
    dates = spark.range(146_097).select(F.expr("date_format(date_add(date'1700-01-01', cast(id AS int)), 'MM/dd/yyyy')").alias("value"))
    dates = dates.where("substring(value, 4, 2) > '12'").select("value", F.col("value").alias("v"), F.expr("'date'").alias("kind"))
    made = dates.select("value", "kind", F.expr(pii.pseudonym("k")).alias("v"))
    back = made.select("value", "v", F.expr(pii.pseudonym("k", invert=True)).alias("back"))
    counted = back.agg(F.count("*"), F.count_distinct("v"), F.count_if(F.col("back") == F.col("value")), F.count_if(F.expr("substring(v, 4, 2) > '12'")))
    assert set(counted.first()) == {88_497}


def test_languages(spark, docs):
    other = [f"{a}{b}" for a in ("sch", "ge", "ver", "un") for b in ("keit", "ung", "lich", "ß")]
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(WORDS if k % 2 else other) for _ in range(30)), "en" if k % 2 else "de") for k in range(400)]
    rows += [(900, None, "en"), (901, "12 !", "en"), (902, "thing", None), (None, "thing", "de")]
    found = language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    known = {r[0]: r[2] for r in rows[:400]}
    held = [r for r in found if r["held_out"] and r["doc_id"] in known]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found if r["doc_id"] is not None} == {True}
    assert len(held) > 40 and sum(known[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] in (900, 901)} == {900: "und", 901: "und"}
    assert language.identify(docs.limit(0)).count() == 0
