"""Licence templates that stand together in one file."""

from riverglass.llm import license_scan


def test_every_template_of_a_file_is_found(spark):
    text = "\n\nand also this\n\n".join(t for _, t, _ in license_scan.TEMPLATES)
    df = spark.createDataFrame([(1, text), (2, "licensed under the mit license"), (3, "no licence")], "doc_id int, text string")
    found = {r.doc_id: [(s.label, s.score) for s in r.template_scores] for r in license_scan.scan_licenses(df).collect()}
    assert sorted(found[1]) == sorted((label, 1.0) for label, _, _ in license_scan.TEMPLATES)
    assert found[2] == [("mit", 1.0)] and found[3] == []
