"""The command line runs the four steps end to end on CSV inputs."""

import pytest

from cohortlens.__main__ import main
from cohortlens.sources import load_model


def test_cli_end_to_end(spark, tmp_path, capsys):
    ev = tmp_path / "events.csv"
    lines = []
    for p in range(1, 41):
        for d in range(1, 2 + p % 7):
            for c in ("DIAG1", "LAB2", "DRUG3")[: 1 + (p + d) % 3]:
                lines.append(f"{p},{c}{p % 5},desc,2000-0{1 + d % 9}-1{d % 9},1.0")
    ev.write_text("\n".join(lines) + "\n")
    mo = tmp_path / "mortality.csv"
    mo.write_text("\n".join(f"{p},2000-12-01,1" for p in range(1, 41, 3)) + "\n")
    out = tmp_path / "out"
    main(["profile", "--events", str(ev), "--mortality", str(mo)])
    assert "events_avg" in capsys.readouterr().out
    with ev.open("a") as f:
        f.write("x,DIAG1,desc,2000-01-01,1.0\n")
    main(["samples", "--events", str(ev), "--mortality", str(mo), "--out", str(out), "--rejects", str(out / "rejects")])
    assert [r.value for r in spark.read.text(str(out / "rejects" / "events")).collect()] == ["x,DIAG1,desc,2000-01-01,1.0"]
    assert spark.read.text(str(out / "training")).count() + \
        spark.read.text(str(out / "testing")).count() == 40
    main(["train", "--samples", str(out / "training"), "--model", str(out / "model"),
          "--eta", "0.5", "--gd", "--steps", "3"])
    main(["train", "--samples", str(out / "training"), "--model", str(out / "sgd"), "--shards", "2"])
    main(["train", "--samples", str(out / "training"), "--model", str(out / "sgd"), "--shards", "1", "--file-order"])
    weights, params = load_model(spark, str(out / "sgd"))
    assert weights.count() > 0 and params["version"] == 2
    main(["evaluate", "--samples", str(out / "testing"), "--model", str(out / "model"),
          "--out", str(out / "eval")])
    assert spark.read.parquet(str(out / "eval" / "auc")).count() == 1
    points = spark.read.parquet(str(out / "eval" / "roc")).count()
    assert points >= 2
    capsys.readouterr()
    main(["evaluate", "--samples", str(out / "testing"), "--model", str(out / "sgd"), "--version", "1"])
    printed = capsys.readouterr().out
    assert "== roc" in printed and "accuracy" in printed


def test_evaluate_refuses_features_beyond_the_model(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 0:1.0\n0 1:1.0\n1 0:1.0\n")
    (tmp_path / "b.txt").write_text("1 7:1.0\n")
    main(["train", "--samples", str(tmp_path / "a.txt"), "--model", str(tmp_path / "m")])
    with pytest.raises(IndexError):
        main(["evaluate", "--samples", str(tmp_path / "b.txt"), "--model", str(tmp_path / "m")])


def test_feature_count_from_max_index():
    from cohortlens.__main__ import _size
    assert (_size(None), _size(0), _size(9)) == (0, 1, 10)
