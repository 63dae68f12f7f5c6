import pytest

from hemicycle import cli


def test_list(capsys):
    assert cli.main(["list"]) == 0
    assert "footprint_topic_deputy" in capsys.readouterr().out


def test_every_verb_has_queries():
    assert all(names and set(names) <= set(cli.QUERIES) for names in cli.VERBS.values())


def test_run(spark, tmp_path):
    assert cli.main(["run", "footprint_contact_bonus", "/root/testdata/sf0.001", "--out", str(tmp_path)]) == 0
    assert spark.read.parquet(f"{tmp_path}/footprint_contact_bonus").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["run", "nothing", "x"])
