"""Every template whose key phrase stands in a file is reached, however many license words the file holds."""

from ledgerlight.llm import licenses

ALL = "agpl,apache,bsd,cc,gpl,isc,lgpl,mit,mpl,unlicense"


def test_a_file_with_all_notices_has_all_labels(spark):
    notices = ". ".join(t for _, t, _ in licenses.TEMPLATES)
    far = (" filler" * 500).join(t for _, t, _ in licenses.TEMPLATES)
    plain = ["permission person files version source terms software copy", "no notice at all"] * 20
    rows = [notices, far, *plain, *[t for _, t, _ in licenses.TEMPLATES]]
    out = {r.doc_id: r for r in licenses.scan(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert out[0].labels == ALL and out[1].labels == ALL
    assert abs(out[0].score - 1) < 1e-9
    assert {out[2 + i].labels for i in range(len(plain))} == {""}
    for i, (label, *_) in enumerate(licenses.TEMPLATES, 2 + len(plain)):
        assert label in out[i].labels.split(",")


def test_a_key_phrase_alone_is_no_notice(spark):
    """Prose that holds only the phrase, and a notice cut so short that little of it stands, get no label."""
    rows = ["We ship binary forms daily.", "Copy, modify that line!", "All rights hereby granted to the winner.",
            "Redistribution and use in source and binary forms, with or without", "no licence word at all", *[t for _, t, _ in licenses.TEMPLATES]]
    out = {r.doc_id: r for r in licenses.scan(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert [out[i].labels for i in range(5)] == ["", "", "", "bsd", ""]
    assert all(out[i].score < 0.5 for i in range(3))
    for i, (label, *_) in enumerate(licenses.TEMPLATES, 5):
        assert label in out[i].labels.split(",")
