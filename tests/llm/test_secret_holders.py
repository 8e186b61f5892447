"""A value in many repositories is a copied example even with one owner."""

from loamfold.llm.secrets import FEW, redacted, secret_spans


def test_both_counts_decide(spark):
    many, few = "qWeRtYuIoPaSdFgHjKlZ1", "qWeRtYuIoPaSdFgHjKlZ2"
    docs = [(i, f"{many} token=abcdef01", "x") for i in range(FEW + 1)] + [(100 + i, f"{few} token=abcdef02", "x") for i in range(FEW)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    spans = {r.doc_id: [(s.kind, s.owners, s.repositories) for s in r.spans] for r in secret_spans(frame).collect()}
    assert spans[0] == [("assign", 1, FEW + 1)] and spans[100] == [("opaque", 1, FEW), ("assign", 1, FEW)]
    texts = {r.doc_id: r.text for r in redacted(frame).collect()}
    assert texts[0] == docs[0][1] and texts[100] == "[secret] [secret]"
