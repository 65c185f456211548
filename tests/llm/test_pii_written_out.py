"""Written-out addresses are scored, reported and redacted."""

from strata.llm import pii


def test_written_out_addresses(spark):
    forms = ("jo.{}[at]host.org", "jo.{} [at] host [dot] org", "jo.{} (at) mail.host(dot)com")
    texts = [f"write to {forms[i % 3].format(i)} soon" for i in range(300)]
    texts += [f"look{i} (at) home. Next line" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.report(df, pii.train(df)).collect()}
    assert all(out[i] == f"email:9:{len(texts[i]) - 5}" for i in range(300))
    assert all(out[i] == "" for i in range(300, 600))
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert all(clean[i] == "write to [EMAIL] soon" for i in range(300))
    assert all(clean[i] == texts[i] for i in range(300, 600))


def test_a_short_table_loses_no_written_out_address(spark):
    rows = [(1, "write to jane [at] host [dot] org"), (2, "nothing here"), (3, None), (4, "look (at) home. Next line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.report(df, pii.train(df)).collect()}
    assert out == {1: "email:9:33", 2: "", 3: "", 4: ""}
    assert pii.report(df.limit(0), pii.train(df.limit(0))).count() == 0
