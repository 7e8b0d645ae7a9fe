import pytest

from ringlens.llm import pii


@pytest.fixture(scope="module", params=[60])
def model(spark, request):
    """Learned from base spans, order codes and years alone; no text has a form that the base patterns leave out."""
    n = request.param
    texts = [f"write a{i}{".b" * (i % 2)}@c{i}.org or +1 ({200 + i}) 555-{1000 + i} in {1900 + i}" for i in range(n)]
    texts += [f"order {10**9 + i * 7919} code {10**8 + i * 17} of 10.{i % 300}.3.4 at {10**15 + i * 31}" for i in range(n)]
    return pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))


ADDED = {
    "mail joe (at) example.org now": ["joe (at) example.org"],
    "x [at] y.org": ["x [at] y.org"],
    "so (555) 123-4567 it is": ["(555) 123-4567"],
    "order 1234567890 and code 572391524": [],
    "he stood (at) home": [],
    "order (555) 123-4567": [],
    "room 1234567": [],
}


def test_other_forms_are_added(spark, model):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    texts = list(ADDED)
    for row in pii.find_personal_data(docs, model).collect():
        spans = [s.split(":") for s in row.spans.split(",") if s]
        assert [texts[row.doc_id][int(a) : int(b)] for _, a, b in spans] == ADDED[texts[row.doc_id]], texts[row.doc_id]
    redacted = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert redacted[0] == "mail [address] now" and redacted[2] == "so [number] it is" and redacted[3] == texts[3]


def test_trees_are_in_the_plan_once(spark):
    """Two added kinds have limits of their own and share one mention of the trees, which the driver plans and compiles."""
    score = "CASE WHEN c.kind = 'address' THEN 0.625D WHEN c.kind = 'number' THEN 0.375D ELSE 0D END"
    docs = spark.createDataFrame([(1, "write x (at) y.org or (201) 345-6789")], "doc_id long, text string")

    def added(address, number):
        found = pii.with_spans(docs, "text", pii.SpanModel(score, {"address": address, "number": number}))
        return [s.kind for s in found.first().added], found._jdf.queryExecution().analyzed().toString().count("0.375")

    both, mentions = added(0.6, 0.3)
    assert set(both) == {"address", "number"} and mentions == 1
    assert set(added(0.6, 0.4)[0]) == {"address"} and set(added(0.7, 0.3)[0]) == {"number"}
    assert set(added(None, 0.3)[0]) == {"number"} and added(0.7, 0.4)[0] == []
