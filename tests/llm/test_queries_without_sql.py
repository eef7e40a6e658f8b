"""Queries that SQL cannot express, run as registered: columns, types, one row for each document, and what the contract fixes."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tokenizers
from conftest import SMALL

from rillhouse.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def rows_of_query(spark, docs, name, **types):
    got = QUERIES[name](spark, SMALL)
    assert {c: t for c, t in got.dtypes if c in types} == types
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows.keys() == docs.keys()
    return rows


def crc(i):
    return zlib.crc32(str(i).encode())


def test_toxicity(spark, docs):
    for i, r in rows_of_query(spark, docs, "op1_toxicity", held_out="boolean", score="double", predicted="int").items():
        assert r["held_out"] == (crc(i) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def test_personal_data(spark, docs):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def holds(kind, text):
        d = [int(c) for c in text if c in "0123456789"]
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in (v * (1 + i % 2) for i, v in enumerate(reversed(d)))) % 10 == 0
        return kind == "email" or (9 <= len(d) <= 15 if kind == "phone" else all(int(p) <= 255 for p in text.split(".")))

    longs = dict.fromkeys([f"n_{k}" for k in plain], "bigint")
    for i, r in rows_of_query(spark, docs, "op3_pii", base_sha256="string", spans="string", **longs).items():
        base = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(plain.items())
                      for m in re.finditer(p, docs[i]) if holds(kind, m[0]))
        listed = [f"{kind}:{s}:{e}" for s, _, e, kind in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(filter(None, r["spans"].split(",")))
        assert [r[f"n_{k}"] for k in plain] == [sum(x[3] == k for x in base) for k in plain]


def test_language_model(spark, docs):
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in docs.items()}
    count = Counter(w for i, ws in tokens.items() if crc(i) % 5 != 1 for w in ws)
    total, v = sum(count.values()), len(count)
    types = {"held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}
    rows = rows_of_query(spark, docs, "op6_language_model", **types)
    for i, r in rows.items():
        ws = tokens[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(i) % 5 == 1, len(ws), sum(w in count for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (v + 1))) for w in ws))
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_bpe(spark, docs):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    for i, r in rows_of_query(spark, docs, "op7_bpe", n_tokens="bigint", ids_sha256="string", decoded_sha256="string").items():
        ids = library.encode(docs[i], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_quality_rules(spark, docs):
    longs = dict.fromkeys(["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], "bigint")
    for i, r in rows_of_query(spark, docs, "op8_quality_rules", base_failed="boolean", kept="boolean", **longs).items():
        t = docs[i]
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(zip(w, w[1:], w[2:]))
        again = len({j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)})
        failed = len(w) < 50 or 100 * again > 50 * len(w)
        assert [r[c] for c in longs] == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), again]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_packing(spark, docs):
    got = QUERIES["op9_packing"](spark, SMALL).collect()
    words = Counter()
    for r in got:
        words[r["doc_id"]] += r["n_tokens"]
    assert {i: n for i, n in words.items() if n} == {i: n for i, t in docs.items() if (n := len(WORD.findall(t)))}


def test_token_counts(spark, docs):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    for i, r in rows_of_query(spark, docs, "op10_token_counts", n_bytes="bigint", n_tokens="bigint", over_limit="boolean").items():
        n = len(library.encode(docs[i], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[i].encode()), n, n > 512)
