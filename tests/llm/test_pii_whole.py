"""op9 on whole documents against a plain version, and texts that once ended the JVM."""

import pytest

from tabspark.llm import pii, queries

from . import plain_pii

KEY = "public example key"


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {texts[r.doc_id]: r for r in pii.pseudonymise(df, KEY).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_documents(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    found = 0
    for r in queries.op9_pii(spark, f"/root/testdata/{sf}").collect():
        text, kinds = plain_pii.pseudonymise(docs[r.doc_id], KEY)
        assert (r.text, r.found) == (text, kinds), r.doc_id
        found += len(kinds)
    assert found > 20


def test_mixed_values(spark):
    texts = ["2024/01/05 and 5/1/2024, 05/01/2024 or 13/1/2024", "4111 1111 1111 1111 2024/01/05", "a@b.c.d. x@y.z 1.2.3.4 123-45-6789",
             "+1 212-555-0100 (212) 555-0100 4111111111111111 12/27 378282246310005", "31/2/2024 2/30/2024 2024/13/01 1/2/34", ""]
    for text, r in run(spark, texts).items():
        assert (r.text, r.found) == plain_pii.pseudonymise(text, KEY), text


def test_a_day_has_one_pseudonym(spark):
    for day in [("2024-12-25", "2024/12/25", "25.12.2024", "12/25/2024", "25/12/2024"), ("2024-01-05", "2024/01/05", "05.01.2024", "01/05/2024", "1/5/2024")]:
        got = {plain_pii.day_of(r.text) for r in run(spark, list(day)).values()}
        assert len(got) == 1 and got != {plain_pii.day_of(day[0])}


def test_very_long_runs(spark):
    rng = range(200_000)
    texts = [" ".join(str(i % 997) for i in rng), "-".join(str(1000 + i % 9000) for i in rng), "x@" + ".".join("a" * 100_000), "7" * 3_000_000,
             " ".join("4111 1111 1111 1111" for _ in range(20_000)), "1." * 100_000, "2024/01/05 " * 20_000, "(212) " * 50_000]
    rows = run(spark, texts)
    assert rows[texts[2]].found == ["email"] and rows[texts[2]].text.endswith(texts[2][1:])
    assert len(rows[texts[4]].found) == 20_000 and "4111" not in rows[texts[4]].text[:100]
    assert len(rows[texts[6]].found) == 20_000
    for text, r in rows.items():
        assert len(r.text) == len(text)
    assert rows[texts[3]].text == texts[3] and rows[texts[5]].text == texts[5]
