"""The command line: each step on its own, and all of them."""

from __future__ import annotations

import json

import pytest

from siltstone.__main__ import main
from siltstone.spec import LOCATIONS

RECORD = dict.fromkeys(LOCATIONS.columns)
RECORDS = [RECORD | {"id": str(i), "state": f"S{i % 2}", "city": "C", "brewery_type": "micro"} for i in range(5)]


@pytest.fixture
def responses(spark, fresh):
    path = f"{fresh}/responses"
    rows = [(1, 200, json.dumps(RECORDS)), (2, 200, "[]")]
    spark.createDataFrame(rows, "page bigint, status int, body string").write.parquet(path)
    return path


def test_step_by_step(fresh, responses, capsys):
    main(["bronze", "--responses", responses, "--root", fresh])
    main(["silver", "--root", fresh, "--strict"])
    main(["gold", "--root", fresh])
    out = capsys.readouterr().out
    assert "bronze: written, 5 rows" in out and "gold: written, 5 rows" in out
    assert "|S0   |C   |micro       |3            |" in out


def test_all_and_again(fresh, responses, capsys):
    first = main(["all", "--responses", responses, "--root", fresh])
    assert [(o.layer, o.status) for o in first] == [(name, "written") for name in ("bronze", "silver", "gold")]
    main(["all", "--responses", responses, "--root", fresh])
    assert "gold: skipped" in capsys.readouterr().out


def test_progress_of_the_ingest(spark, fresh, responses):
    main(["all", "--responses", responses, "--root", fresh, "--progress", f"{fresh}/progress"])
    assert [tuple(r) for r in spark.read.parquet(f"{fresh}/progress").collect()] == [(1, 5, 5)]


def test_what_a_step_needs(capsys):
    with pytest.raises(SystemExit):
        main(["fetch", "--responses", "x"])
    assert "fetch needs --url" in capsys.readouterr().err


def test_flags_count_or_are_refused(fresh, spark, capsys):
    bad = [RECORD | {"id": "1", "state": "S", "city": "C", "longitude": "bad"}]
    path = f"{fresh}/bad"
    spark.createDataFrame([(1, 200, json.dumps(bad)), (2, 200, "[]")], "page bigint, status int, body string").write.parquet(path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        main(["all", "--responses", path, "--root", f"{fresh}/a", "--strict"])
    with pytest.raises(Exception, match="bad_numbers on silver: 1"):
        main(["all", "--responses", path, "--root", f"{fresh}/b", "--allowed-bad-numbers", "0"])
    outcomes = main(["all", "--responses", path, "--root", f"{fresh}/c", "--arrays", "--last-pair-wins", "--keep-other-leaves"])
    assert [o.n_rows for o in outcomes] == [1, 1, 1]
    for step, flag in (("all", "--leaf-files"), ("bronze", "--strict"), ("gold", "--piece-rows=5"), ("fetch", "--arrays")):
        with pytest.raises(SystemExit):
            main([step, "--responses", path, "--root", fresh, "--url", "u", flag][: 6 if step != "gold" else None])
        with pytest.raises(SystemExit):
            main([step, flag, "--root", fresh, "--responses", path, "--url", "u"])


def test_gold_with_parts(fresh, responses):
    main(["all", "--responses", responses, "--root", fresh, "--parts", f"{fresh}/parts"])
    again = main(["gold", "--root", fresh, "--parts", f"{fresh}/parts"])
    assert [(o.status, o.n_rows, o.n_leaves) for o in again] == [("written", 5, 2)]
    with pytest.raises(SystemExit):
        main(["silver", "--root", fresh, "--parts", f"{fresh}/parts"])
