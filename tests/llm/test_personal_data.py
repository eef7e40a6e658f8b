"""Spans that trees add, in small tables and for rare kinds."""

from rillhouse.llm import pii

NAMES = ["al", "anna", "josef", "maria", "marius"]
#: The base pattern takes ASCII letters only.
MISSED = "josé@mail3.example.com"


def luhn_number(i):
    body = f"4{i * 7919 % 10**14:014d}"
    odd = sum(x - 9 if x > 9 else x for x in (int(c) * (2 - k % 2) for k, c in enumerate(body)))
    return body + str(-odd % 10)


def added(spark, texts, model=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_personal_data(docs, model=model).where("size(found) > size(base_found)").collect()
    return {r["text"][x["s"]:x["e"]]: x["kind"] for r in rows for x in r["found"] if x not in r["base_found"]}


def test_few_examples(spark):
    texts = [f"write to {NAMES[i % 5]}@mail{i % 9}.example.com soon, no. {i}" for i in range(40)]
    texts += [f"server host 10.{i}.{i * 7 % 200}.5 is up" for i in range(40)] + [f"pay card {luhn_number(i)} now" for i in range(40)]
    texts += [f"call +1 ({200 + i}) 555-{1000 + i * 37} today" for i in range(40)]
    assert added(spark, [*texts, f"write to {MISSED} soon, no. 5"]) == {MISSED: "email"}
    assert added(spark, ["no. 1234567 here"]) == {}


def test_rare_kind(spark):
    texts = [f"order 99{i:06d} shipped" for i in range(8000)] + [f"write to {NAMES[i % 5]}@mail{i % 9}.example.com soon, no. {i}" for i in range(80)]
    model = pii.fit(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"))
    assert set(model) == {"email"}
    assert added(spark, [f"write to {MISSED} soon, no. 5"], model) == {MISSED: "email"}
