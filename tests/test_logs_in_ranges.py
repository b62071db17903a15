"""Logs whose files are longer than what one task orders."""

from opalgrid.plans.registry import GRAMMAR
from opalgrid.sources import logs


def lines(spark):
    text = ["stray", "-----Acq", "a,b,1,2,c", "Run Name: 1", "x", "interval: 4", "after, it", "interval: 5", *["more"] * 9, "Name: 2", "t", "v 1LOW", "w 23", "Run Name: 1", *["y"] * 9, "interval: 6", "z"]
    return spark.createDataFrame([(f, 3 * k, t) for f in (1, 2, 3) for k, t in enumerate(text)], "file long, line long, text string")


def test_a_file_in_many_ranges_gives_what_one_range_gives(spark, monkeypatch):
    rows = lines(spark)
    found = lambda: (sorted(map(tuple, logs.by_grammar(rows, GRAMMAR).collect())), sorted(map(tuple, logs.sections(rows, [("acquisition", "^-----Acq"), ("other", "Name: 2")]).collect())))
    whole = found()
    monkeypatch.setattr(logs, "RANGE", 5)
    assert logs._ranged(rows).select("_part").distinct().count() > 10
    assert found() == whole
    after = [r for r in whole[0] if r[0] == 1 and r[1] == "after"]
    assert [r[5] for r in after] == ["after", "it", "interval: 5", *["more"] * 9, "z"]
    assert [r[5] for r in whole[0] if r[0] == 1 and r[1] == "run"] == ["6"]
