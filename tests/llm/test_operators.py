"""Operators against brute force, exact round trips and held-out accuracy, with odd inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from rillhouse.llm import (bpe, exact_search, language_model, near_duplicates, packing, pii, quality, token_counts,
                           toxicity, url_filter)

ODD = [None, "", " \n\t", "é😀 \u2028x", "a" * 3000, "The The\nThe The", "x\x1cy"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_frame(spark, texts):
    """Texts with ids, a null id, a repeated row and columns whose names an operator uses itself."""
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)] + [(None, "no id", 1, "k"), (0, texts[0], 1, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, score int, kept string")


def test_url_rules(spark):
    rules = [("allow", "com", "/"), ("block", "a.com", "/en/"), ("allow", "w.a.com", "/en/"), ("block", "b", "/x"),
             ("allow", "b", "/xy"), ("allow", None, "/"), ("block", "b", "/xy")]
    urls = [None, "", "no url", "http://", "x://A.COM/en/1?q", "x://w.a.com/en/", "x://z.b/xyz", "x://b/x#", "x://.com/", "x://ba.com/en/"]
    pages = spark.createDataFrame([*enumerate(urls), (None, "x://b/x")], "page_id long, url string")

    def brute(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, "allow")

    got = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules)).collect()
    assert sorted((tuple(r[1:]) for r in got), key=str) == sorted((brute(u) for u in [*urls, "x://b/x"]), key=str)
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark, [])).count() == 0


def test_bpe_and_counts_equal_the_library(spark):
    words, multi = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    a, b = tokenizers.Tokenizer.from_file(words), tokenizers.Tokenizer.from_file(multi)
    dice = random.Random(2)
    letters = [chr(i) for i in [*range(0, 0x250), 0x3a3, 0x130, 0x301, 0x3000, 0x4e2d, 0x1f600, 0xb2]] + ["<|endoftext|>", "'ll", "  ", "\n"]
    texts = ODD[1:] + ["".join(dice.choice(letters) for _ in range(dice.randrange(60))) for _ in range(300)]
    codec, counter = bpe.codec(words), token_counts.counter(multi)
    for t in texts:
        ids = a.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == ids and codec.decode(ids) == a.decode(ids, skip_special_tokens=False)
        assert counter.count(t) == len(b.encode(t, add_special_tokens=False).ids)
    rows = bpe.encode_digests(texts_frame(spark, ODD), words).collect()
    assert len(rows) == len(ODD) + 2 and rows[0]["n_tokens"] == 0
    assert token_counts.count_tokens(texts_frame(spark, ODD), multi).count() == len(ODD) + 2


def test_quality_statistics_and_rules(spark):
    def brute(t):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(zip(w, w[1:], w[2:]))
        hit = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)

    texts = ODD + ["a b c a b c d", "x x x x", "l 1\nl 1\n\nl 1", "# | <a>"]
    labels = spark.createDataFrame([(i, None) for i in range(3)], "doc_id long, quality int")
    got = quality.judge_quality(texts_frame(spark, texts), labels).collect()
    assert len(got) == len(texts) + 2 and not any(r["kept"] for r in got)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])
    zero = dict.fromkeys(quality.FEATURES, 0.1)
    rules = quality.learn_rules([{**zero, "symbols_per_word": 0.9 if i % 4 == 0 else 0.0, "bad": int(i % 4 == 0)} for i in range(200)])
    assert len(rules) == 1 and rules[0][0].feature == "symbols_per_word" and rules[0][0].above


def test_personal_data(spark):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(x - 9 if x > 9 else x for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0

    def brute(t):
        out = []
        for k, (kind, p) in enumerate(plain.items()):
            for m in re.finditer(p, t or ""):
                d = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                        "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                    out.append((m.start(), k, m.end(), kind))
        return sorted(out)

    dice = random.Random(5)
    bits = ["1", "25", "256", ".", "a@", "b.c", "@", "-", " ", "+", "+1 (555) 555-1234", "4111 1111 1111 1111", "_x@y.com", "é", "😀", "\n"]
    texts = ODD + ["".join(dice.choice(bits) for _ in range(dice.randrange(25))) for _ in range(200)] + ["1 " * 1500, "a@b" + ".c" * 2000]
    got = pii.find_personal_data(texts_frame(spark, texts), model={}).withColumn("clean", pii.redacted(F.col("text"), F.col("found"))).collect()
    assert len(got) == len(texts) + 2
    assert all([tuple(x) for x in r["base_found"]] == brute(r["text"]) for r in got)
    assert all(r["clean"] == r["text"] for r in got if not r["found"])


def brute_groups(rows, n, threshold):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        sets.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j, (_, a) in enumerate(sets):
        for k, (_, b) in enumerate(sets[:j]):
            if a and 100 * len(a & b) >= threshold * len(a | b):
                root[find(j)] = find(k)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def test_near_duplicates(spark):
    dice = random.Random(4)
    base = [dice.choice("abcdefgh") for _ in range(60)]
    rows = []
    for i in range(120):
        words = list(base) if i % 3 else [dice.choice("abcdefghijk") for _ in range(dice.randrange(50))]
        for _ in range(dice.randrange(5)):
            if words:
                words[dice.randrange(len(words))] = dice.choice("wxyz")
        rows.append((i, " ".join(words)))
    rows += [(200 + i, t) for i, t in enumerate([None, "", "A b", "a  B\n", "x " * 4000, "x " * 40])] + [(0, rows[0][1])]
    got = near_duplicates.link_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, got)) == brute_groups(rows, 4, 85)


def test_near_duplicates_without_ids_and_with_repeated_ones(spark):
    """Rows without id are members like others; one id with two texts is two members."""
    base = " ".join(f"word{i}" for i in range(60)) + " "
    rows = [(None, base + f"x{i}") for i in range(3)] + [(7, base + "x1"), (7, "quite another text of a few words"), (9, base + "x9"),
                                                        (5, "quite another text of a few words"), (None, "quite another text of a few words"), (None, None)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, node int, sign string")
    got = sorted(map(tuple, near_duplicates.link_near_duplicates(df, 4, 85).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(None, 7)] * 3 + [(7, 7), (7, 5), (9, 7), (5, 5), (None, 5), (None, None)], key=str)
    assert near_duplicates.link_near_duplicates(df.limit(0)).collect() == []


def test_difference_filter_keeps_all_links():
    dice = np.random.default_rng(3)
    for _ in range(300):
        a = dice.choice(2000, dice.integers(1, 400), replace=False).astype(np.uint64)
        b = np.concatenate([a[: dice.integers(0, len(a) + 1)], dice.choice(2000, dice.integers(0, 60)).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        bits = sum(bin((x ^ y) & (2 ** 64 - 1)).count("1") for x, y in zip(near_duplicates._mark(a), near_duplicates._mark(b)))
        assert len(np.setxor1d(a, b)) >= bits


def test_exact_search(spark):
    dice = random.Random(3)
    vectors = [[dice.uniform(-1, 1) for _ in range(8)] for _ in range(150)] + [None, [], [1.0, None] * 4, [float("nan")] * 8, [0.0] * 8, [1.0, 2.0]]
    vectors += [vectors[0]] * 30
    got = exact_search.top_k(spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, rank int"),
                             F.col("vec_id") % 20 == 0, k=5).collect()
    whole = {i: [math.floor(64 * x) for x in v] for i, v in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v)}
    want = [(q, r, i, -s) for q in whole if q % 20 == 0 for r, (s, i) in enumerate(sorted(
        (-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_language_model(spark):
    texts = [t for t in ODD if t is None or len(t) < 100] + ["a b a b c", "a b d e", "b a B a", "unseen words"]
    docs = texts_frame(spark, texts)
    train = [t for t in texts if t != "unseen words"]
    model = language_model.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    tokens = lambda t: [*[w for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())], None]
    uni, pairs = Counter(), Counter()
    for t in train:
        w = tokens(t)
        uni.update(w)
        pairs.update(zip(["begin", *w], w))
    after = Counter(w for _, w in pairs)
    of = lambda c: language_model._discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])
    d, e, v, total = of(pairs), of(after), len(uni), sum(uni.values())
    cut = lambda c, x: x[min(c, 3) - 1] if c else 0
    mass = sum(cut(c, e) for c in after.values()) / len(pairs)
    for r, t in zip(language_model.score_texts(docs, model).collect(), texts):
        score = base = 0
        for u, w in zip(["begin", *tokens(t)], tokens(t)):
            p = (after[w] - cut(after[w], e)) / len(pairs) + mass / (v + 1)
            n = sum(c for (x, _), c in pairs.items() if x == u)
            if n:
                p = (pairs[u, w] - cut(pairs[u, w], d) + sum(cut(c, d) for (x, _), c in pairs.items() if x == u) * p) / n
            score += math.log10(p)
            base += math.log10((uni[w] + 0.5) / (total + 0.5 * (v + 1)))
        assert r["train_tokens"] == total and r["score"] == pytest.approx(score) and r["base_score"] == pytest.approx(base)
    empty = language_model.fit(spark.createDataFrame([], "text string"))
    assert all(r["score"] == 0 for r in language_model.score_texts(docs, empty).collect())


def test_toxicity_held_out(spark):
    dice = random.Random(1)
    syllables = ["ta", "ro", "mi", "nel", "sou", "par", "dek"]
    clean = lambda: [dice.choice(syllables) + dice.choice(syllables) for _ in range(dice.randrange(10, 80))]
    texts = []
    for i in range(600):
        w = clean()
        if i % 2:
            for _ in range(3):
                w[dice.randrange(len(w))] = dice.choice(["vilewretch", "grubby", "odious"])
        texts.append((" ".join(w), i % 2))
    scorer = toxicity.Scorer(toxicity.fit(spark.createDataFrame(texts[:480], "t string, y int")))
    right = sum((s >= 0.5) == bool(y) for s, (_, y) in zip(scorer.scores([t for t, _ in texts[480:]]), texts[480:]))
    assert right >= 115
    assert scorer.scores(["odiouss taro rota"])[0] > scorer.scores(["taro rota"])[0]
    none = toxicity.fit(spark.createDataFrame([], "t string, y int"))
    assert [r["score"] for r in toxicity.score_toxicity(texts_frame(spark, ODD), none).collect()] == [0.5] * (len(ODD) + 2)


def test_packing(spark):
    histogram = {1: 5, 2: 1, 7: 4, 8: 9, 20: 2}
    bounds = packing.best_boundaries(histogram, 2)
    cost = lambda bs: sum(n * min(b for b in bs if b >= x) for x, n in histogram.items())
    assert cost(bounds) == min(cost([b, 20]) for b in histogram)
    rows = packing.pack(texts_frame(spark, ODD + ["w " * 25] * 9), max_length=10, buckets=2, budget=40).collect()
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 9) == 25
    batches = Counter((r["bucket"], r["batch"]) for r in rows)
    assert all(n <= max(1, 40 // b) for (b, _), n in batches.items())
    assert packing.pack(texts_frame(spark, ODD).limit(0)).count() == 0
