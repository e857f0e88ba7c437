"""The commands over snapshots and glossaries."""

import pytest

from lexispark import cli, fixed
from lexispark.sources import files


@pytest.fixture(scope="module")
def glossary(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    names = ["wool", "Hem", "apple", "Zip", "hem", "Wool"]
    rows = [("en", "de-DE", n.lower(), "general", n, f"{n} auf Deutsch", "approved", 0.9, 0.9, 1, i) for i, n in enumerate(names)]
    schema = "source_locale string, target_locale string, normalized_source string, domain string, source_term string, target_term string, status string, similarity double, final_score double, frequency long, id long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/snapshot")
    cli.main(["export", "--snapshot", f"{folder}/snapshot", "--out", f"{folder}/glossary"], spark)
    return folder


def test_export_is_in_the_order_of_a_dictionary(spark, glossary):
    (part,) = (glossary / "glossary").glob("part-*.csv")
    terms = [line.split(",")[0] for line in part.read_text().splitlines()[1:]]
    assert terms == ["apple", "Hem", "hem", "Wool", "wool", "Zip"]


def test_rebase_makes_another_locale_the_key(spark, glossary):
    cli.main(["rebase", "--glossary", f"{glossary}/glossary", "--locale", "de-DE", "--out", f"{glossary}/rebased"], spark)
    out = files.read_csv(spark, f"{glossary}/rebased")
    assert out.columns[0] == "de-DE" and {r[fixed.SOURCE_LOCALE] for r in out.collect()} >= {"apple", "Zip"}


def test_reports_are_printed(spark, glossary, capsys):
    cli.main(["stats", "--snapshot", f"{glossary}/snapshot"], spark)
    out = capsys.readouterr().out
    assert "approved" in out and "phase2" in out
    cli.main(["audit", "--glossary", f"{glossary}/glossary"], spark)
    assert "n_words" in capsys.readouterr().out
