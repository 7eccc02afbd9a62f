"""The whole pipeline on a small table against plain Python of all five stages."""

import hashlib
import random
import re

from tokenizers import Tokenizer

import corpus_pipeline
from corpusmix.llm.queries import TEST_KEY, tokenizer_path

WORDS = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "in") for b in ("ing", "ed", "tion", "ly", "al", "s")]


def prose(seed, words=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def failed(text):
    words = (text or "").split()
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return len(words) < 20 or 100 * len(covered) > 30 * len(words)


def shrunk_rates(rows):
    hosts = {}
    for _, text, host in rows:
        n, f = hosts.get(host, (0, 0))
        hosts[host] = n + 1, f + failed(text)
    n, f = (sum(h[k] for h in hosts.values()) for k in (0, 1))
    mean = f / n
    chance = mean * (1 - mean)
    spread = sum(b * b / a for a, b in hosts.values()) - n * mean * mean - chance * (len(hosts) - 1)
    rho = spread / (chance * (n - sum(a * a for a, _ in hosts.values()) / n - (len(hosts) - 1) + 100))
    weight = max(1 / rho - 1, 0)
    return {host: (b + mean * weight) / (a + weight) for host, (a, b) in hosts.items()}


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def groups(rows):
    """The least id that each row reaches over links."""
    root = {row[0]: row[0] for row in rows}

    def find(k):
        return k if root[k] == k else find(root[k])

    for a in rows:
        for b in rows:
            one, other = shingles(a[1]), shingles(b[1])
            if a[0] < b[0] and 100 * len(one & other) >= 80 * len(one | other):
                low, high = sorted((find(a[0]), find(b[0])))
                root[high] = low
    return {k: find(k) for k in root}


def edits_within(item, text):
    """Fewest edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def masked(text):
    def mail(found):
        digest = hashlib.sha256(f"{TEST_KEY}/text/{found[0].lower()}".encode()).hexdigest()
        return f"u{digest[:12]}@m{digest[12:18]}.example"

    return re.sub(r"[a-z.]+@[a-z]+\.[a-z]+", mail, text)


def test_run_equals_plain_python(spark, tmp_path):
    item = prose(900, 9)[:48]
    texts = [prose(k) for k in range(30)]
    texts += [texts[3] + " more", texts[3], texts[4] + " jane.doe@mail.org", texts[29].replace("ing", "xx", 1)]
    texts += [f"{prose(50)} {item} {prose(51)}", f"{prose(52)} {item[:20]}#{item[21:]} {prose(53)}", f"{prose(54)} {item[:25]} {prose(55)}"]
    texts += ["so short", "", None, "ab cd " * 30, prose(60) + " write to a.b@c.de or A.B@c.de".lower()]
    rows = [(k, text, f"s{k % 3}") for k, text in enumerate(texts)]
    rows += [(100 + k, "bad one", "bad") for k in range(60)] + [(200, prose(200), "bad"), (201, prose(201), None)]
    whole = spark.createDataFrame([(k, t, "en", s, len(t or "")) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars int")
    whole.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    rates = shrunk_rates(rows)
    assert rates["bad"] > 0.5 > max(rate for host, rate in rates.items() if host != "bad")
    left = [row for row in rows if not failed(row[1]) and rates[row[2]] <= 0.5]
    group = groups(left)
    left = [row for row in left if group[row[0]] == row[0]]
    left = [row for row in left if edits_within(item, " ".join(row[1].lower().split())) > 2]
    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    expected = {}
    for doc_id, text, _ in left:
        ids = library.encode(masked(text), add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[doc_id] = len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == expected
    assert len(found) == len(expected) and {31, 30, 34, 35, 37, 38, 39, 40, 200}.isdisjoint(expected) and {36, 41, 201} <= set(expected)
