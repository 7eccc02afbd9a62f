"""Licence scans, spelling variants and collocations against brute force, on small tables of odd cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpusmix.llm import collocations, licences, spelling
from corpusmix.llm.oracle import ORACLE
from corpusmix.llm.queries import QUERIES, op11_license_scans
from oracle_check import connect

SCHEMA = "doc_id bigint, text string, lang string, n string, word string, spans string, chunk string"


def table(spark, rows):
    """Documents with further columns that are named as the operators' own."""
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA).repartition(3)


def lines(df, *names):
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_collocations"])
def test_rows_and_kinds_equal_the_sql(spark, tables, name):
    got = QUERIES[name](spark, tables).toArrow()
    expected = connect(tables).sql(ORACLE[name]).to_arrow_table().select(got.column_names)
    assert [f.type for f in got.schema] == [f.type for f in expected.schema]
    assert sorted(map(repr, got.to_pylist())) == sorted(map(repr, expected.to_pylist()))
    assert got.num_rows > 0


# --- licences ----------------------------------------------------------------------------------


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


TEMPLATES = [(label, words_of(t)) for label in sorted(licences.NOTICES) for t in licences.NOTICES[label]]
GRANT = licences.NOTICES["mit"][2]


def plain_phrases(words):
    found = []
    for phrase, label in licences.PHRASES.items():
        parts = phrase.split()
        found += [(label, i) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return sorted(found)


def plain_runs(words, template):
    """All pairs of equal runs of a text and a template that cannot be made longer on either side."""
    runs = []
    for i in range(len(words)):
        for j in range(len(template)):
            if words[i] != template[j] or (i and j and words[i - 1] == template[j - 1]):
                continue
            size = 0
            while i + size < len(words) and j + size < len(template) and words[i + size] == template[j + size]:
                size += 1
            runs.append((i, j, size))
    return runs


LICENSED = [
    None,
    "",
    " .,- \n",
    "Released under the MIT License.",
    "released UNDER the\nmit-license, all rights reserved. All Rights Reserved",
    "prose before " + GRANT + " prose after",
    "x " + GRANT.replace("free of charge", "gratis and free of all charge") + " y",
    GRANT[: len(GRANT) // 3],
    licences.NOTICES["gpl-3.0"][1] + " " + licences.NOTICES["apache-2.0"][1],
    "Licensed under CC BY-NC 4.0. " * 40,
    "general public license general public general public license",
    "the license and the software are provided to any person without restriction of the terms",
    "mots français été général " + licences.NOTICES["bsd"][0].upper(),
    "all rights " * 5_000 + "reserved",
    "cc by",
]


def test_licences_of_odd_texts(spark):
    rows = [(k, t, None) for k, t in enumerate(LICENSED)] + [(None, LICENSED[3], "en"), (3, LICENSED[3], "en")]
    found = licences.find_licences(table(spark, rows))
    assert found.columns == ["doc_id", "n_words", "places", "spans"]
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        words = words_of(LICENSED[3] if row["doc_id"] is None else LICENSED[row["doc_id"]])
        assert row["n_words"] == len(words)
        assert sorted(tuple(p) for p in row["places"]) == plain_phrases(words)
        for label, first, last, share in row["spans"]:
            longest = [t for other, t in TEMPLATES if other == label]
            runs = [r for t in longest for r in plain_runs(words[first : last + 1], t)]
            assert licences.LEAST_SHARE <= share <= 1 and max(r[2] for r in runs) >= licences.LEAST_MATCH
    labels = {r["doc_id"]: r["labels"] for r in licences.licence_digest(found.where("doc_id is not null")).collect()}
    assert labels[3] == "mit" and labels[4] == "mit,reserved" and labels[5] == "mit" and labels[6] == "mit"
    assert labels[7] == "" and labels[8] == "apache-2.0,gpl,gpl-3.0" and labels[9] == "cc-by,cc-by-nc"
    assert labels[10] == "gpl" and labels[11] == "" and labels[12] == "bsd" and labels[13] == "reserved" and labels[14] == "cc-by"
    spans = {r["doc_id"]: r["spans"] for r in got if r["doc_id"] is not None}
    assert len(spans[9]) == 40 and spans[6][0]["share"] < 1 and spans[5][0]["share"] == 1
    assert (spans[5][0]["first_word"], spans[5][0]["last_word"]) == (2, 1 + len(words_of(GRANT)))


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(2, 14))] for _ in range(7)] + [[1] * 9, [1] * 9]
    automaton = licences.SuffixAutomaton(sequences)
    for _ in range(300):
        text = [rng.randrange(4) for _ in range(rng.randrange(25))]
        for at, (state, length) in enumerate(automaton.stream(text)):
            run = next(
                text[i : at + 1] for i in range(at + 2) if any(holds(s, text[i : at + 1]) for s in sequences)
            )
            assert length == len(run)
            if run:
                places = [(k, e) for k, s in enumerate(sequences) for e in range(len(s)) if s[e + 1 - len(run) : e + 1] == run and e + 1 >= len(run)]
                assert sorted(automaton.places(state)) == places


def holds(sequence, run):
    return any(sequence[i : i + len(run)] == run for i in range(len(sequence) - len(run) + 1))


def test_single_runs_make_the_spans_that_brute_force_finds():
    """Texts with one piece of one template: a span if the piece has enough of its words."""
    rng = random.Random(8)
    scanner = licences.Scanner.of(licences.NOTICES, {})
    for label, template in TEMPLATES:
        for _ in range(6):
            first = rng.randrange(len(template) // 3 + 1)
            piece = template[first : rng.randrange(first + 2, len(template) + 1)]
            text = " ".join(["zz"] * 3 + piece + ["zz"])
            ((_, _, spans),) = licences.scan_texts(scanner, [text], 4, 8, 0.75)
            enough = len(piece) >= min(4, len(template)) and len(piece) >= 0.75 * len(template)
            assert ((label, 3, 2 + len(piece), len(piece) / len(template)) in spans) == enough


def test_licences_of_an_empty_table_and_bad_templates(spark, tables):
    empty = licences.licence_digest(licences.find_licences(table(spark, []).limit(0)))
    assert empty.collect() == [] and empty.columns == op11_license_scans(spark, tables).columns
    with pytest.raises(ValueError):
        licences.Scanner.of({"one": ("word",)}, {})


def test_license_query_counts_every_phrase(spark, tables):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    for row in op11_license_scans(spark, tables).collect():
        words = words_of(docs[row["doc_id"]])
        places = plain_phrases(words)
        starts = [at for _, at in places]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({label for label, _ in places}))
        assert set(row["base_labels"].split(",")) <= {*row["labels"].split(","), ""} and 0 <= row["score"] <= 1


# --- spelling variants ------------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, times):
    out = []
    forms = {}
    for word, n in counts.items():
        others = sorted((-m, o) for o, m in counts.items() if near(word, o))
        if others and -others[0][0] >= times * n:
            forms[word] = others[0][1]
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, n, sum(near(word, o) for o in counts), counts.get(form)))
    return sorted(out, key=repr)


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    counts = {}
    for base in ("aaaaaa", "abcdef", "naïveté", "mississippi", "ÀÉaaaa"):
        for _ in range(60):
            word = list(base)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(word))
                word[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "é", "s", "ss"])
            counts["".join(word) or "x"] = rng.choice([1, 2, 5, 5, 24, 25, 125, 700, 10**12])
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 5, "x")], "word string, n bigint, range string")
    assert lines(spelling.spelling_variants(frame.repartition(4)), *NAMES) == plain_variants(counts, 5)
    assert spelling.spelling_variants(frame.limit(0)).collect() == []


def test_word_counts_equal_brute_force(spark):
    rng = random.Random(4)
    letters = ["lettre", "Lettres", "LETTRE", "ÉCOLE", "écoles", "motmot", "wörter", "x×÷yzz", "short", "a" * 300]
    rows = [(k, " 1".join(rng.choice(letters) for _ in range(200)), "en") for k in range(40)]
    rows += [(None, "lettre " * 400, None), (3, None, "en"), (4, "", "en"), (1, rows[1][1], "en")]
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    expected = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = spelling.word_counts(table(spark, rows), slip_every=7)
    assert dict(lines(got, "word", "n")) == expected and len(expected) > 8
    assert spelling.word_counts(table(spark, rows).limit(0)).collect() == []


def test_a_range_holds_few_words(spark):
    """Twenty-six words that differ in one letter share a range, and no other range is larger."""
    words = [(f"common{c}word", 5) for c in "abcdefghijklmnopqrstuvwxyz"] + [("commonword", 9)]
    ranges = spelling.rotations(spark.createDataFrame(words, "word string, n bigint")).groupBy("range").count()
    assert ranges.agg({"count": "max"}).first()[0] == 27


# --- collocations -------------------------------------------------------------------------------------


def plain_collocations(rows, least, covering, top, most):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            sizes[lang or "und"] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= covering * a and holds(list(q), list(p)) for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out, key=repr)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mined_rows():
    rng = random.Random(6)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "ß", "naïve", " x", "$a", "zz", "𝒳"]
    rows = []
    for k in range(120):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(["new york city", *vocabulary]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \x0b"])
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), (" .,\n", "fr"), ("a a a a a a a a a a a a a", "fr"), ("only", "cy")]


@pytest.mark.parametrize("most,least,covering,top", [(3, 10, 50, 2000), (2, 3, 50, 5), (4, 5, 80, 40)])
def test_collocations_equal_brute_force(spark, most, least, covering, top):
    rows = mined_rows()
    docs = table(spark, [(k, *row) for k, row in enumerate(rows)])
    got = collocations.collocations(docs, most, least, covering, top)
    expected = plain_collocations(rows, least, covering, top, most)
    assert lines(got, *COLUMNS) == expected and len(expected) > 4


def test_chunks_do_not_change_the_counts(spark):
    words, counts, codes = collocations.chunk_words(["a b. a", "", "b  a\tc"])
    assert dict(zip(words, counts.tolist())) == {"a": 3, "b": 2, "c": 1}
    assert [words[c - 1] if c else 0 for c in codes.tolist()] == ["a", "b", 0, "a", 0, 0, "b", "a", "c"]


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(table(spark, []).limit(0)).collect() == []
    assert collocations.collocations(table(spark, [(1, None, None), (2, " . ", "en")])).collect() == []
    with pytest.raises(ValueError):
        collocations.collocations(table(spark, []), most_words=1)


def test_scores_of_large_counts_are_exact(spark):
    a, left, right = 9 * 10**13 + 7, 9 * 10**14 + 1, 10**14 + 3
    frame = spark.createDataFrame([(a, [left, a], [a, right])], "a bigint, heads array<bigint>, tails array<bigint>")
    cut = frame.select(collocations._lowest_cut(2).alias("cut")).first()["cut"]
    assert cut["score"] == 1_000_000 * a * a // (left * right) and (cut["l"], cut["r"]) == (left, right)
