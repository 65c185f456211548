"""Base spans against Python's ``re``; the model's additions; redaction."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from strata.llm import pii
from strata.llm.queries import op1_pii
from tests.conftest import SF_SMALL

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, kind in enumerate(pii.KINDS)
             for m in re.finditer(RULES[kind], text or "") if valid(kind, m.group())]
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


EDGES = [
    None, "", "no data", "a@b.c", "x@y", "a@b.com@c.org", "a@b@c.de.", "é a.b+c@d-e.f.g..h", "a@b.com_x@d.org q",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1 1.2.3", "0256.1.1.1 000255.0.0.01", "4041894974608795",
    "4041 8949-7460 8795", "4041  894974608795", "+1 (988) 555-2485", "+1 (269) 555-3296 4524132264652876 on",
    "+12345678", "0000000000000", "🙂🙂 a@b.co 🙂 10.0.0.1", "1" * 60, "7" * 30000, "a" * 60000, "a." * 20000 + "@b",
    "x@" + "b.c" * 9000, "1-" * 20000, "10.0.0.1 " * 900, "+" * 500 + "1 23456789", "mail: q@r.st\n call +49 30 1234567"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")


def check(spark, texts):
    for r in pii.report(frame(spark, texts), pii.Model()).collect():
        want = brute(texts[r.doc_id])
        assert r.spans == want
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        kinds = Counter(x.split(":")[0] for x in want.split(",") if x)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.KINDS)


def test_base_on_edges(spark):
    check(spark, EDGES + EDGES)


def test_base_on_random_texts(spark):
    rng = random.Random(11)
    check(spark, ["".join(rng.choices("01249a@.-+ ()é_", k=rng.randrange(60))) for _ in range(1500)])


def test_query_keeps_the_base_and_adds_masked_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op1_pii(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))


def corpus(spark):
    texts = [f"words here +1 (2{i % 90 + 10}) 555-{1000 + i} more words" for i in range(300)]
    texts += [f"paid with 404189497460{8795} today" for _ in range(300)]
    texts += [f"order {100000000000 + 7 * i} shipped" for i in range(300)]
    texts += ["joined +1 (269) 555-3296 4041894974608795 end", "or call (269) 555-3296 now", "plain words only"]
    return frame(spark, texts), len(texts)


def test_model_adds_what_the_base_drops(spark):
    df, n = corpus(spark)
    model = pii.train(df)
    out = {r.doc_id: r.spans for r in pii.report(df, model).collect()}
    assert out[n - 3] == "phone:7:24,card:25:41"
    assert out[n - 1] == ""
    assert all(out[i] == "" for i in range(600, 900) if not brute(f"order {100000000000 + 7 * (i - 600)} shipped"))
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[n - 3] == "joined [PHONE] [CARD] end" and clean[n - 1] == "plain words only"


def test_redaction_of_overlaps_and_nulls(spark):
    texts = [None, "", "é +4041894974608795 z", "a@b.co10.0.0.1 x", "a@b.co a@b.co"]
    df = frame(spark, texts)
    out = {r.doc_id: (r.text, r.spans) for r in pii.redact(df).collect()}
    assert out == {0: (None, "clash"), 1: ("", "clash"), 2: ("é +[CARD] z", "clash"),
                   3: ("[EMAIL] x", "clash"), 4: ("[EMAIL] [EMAIL]", "clash")}
    assert pii.redact(df.limit(0)).count() == 0


def test_trees_and_their_expression_agree(spark):
    df, _ = corpus(spark)
    model = pii.train(df)
    names = [f for f, _ in pii.FEATURES]
    from pyspark.sql import functions as F
    c = F.col("c")
    rows = (df.select(F.explode(pii.candidates(F.col("text"))).alias("c"))
            .select(*[c[f].alias(f) for f in names], model.column(c).alias("score")).collect())
    x = np.array([[r[f] for f in names] for r in rows])
    assert np.allclose(model.score(x), [r.score for r in rows])


def test_native_plan(spark):
    df = frame(spark, ["x"])
    plan = pii.report(df, pii.Model(0.0, [(1, 0, -1.0, 1.0)], {"card": 0.5}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
