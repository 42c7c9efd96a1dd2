import pytest

from pairlore.__main__ import arguments, main

from conftest import GOLDEN, rows


@pytest.mark.parametrize(
    "argv",
    [[], ["0.5"], ["0.5", "x", "--input", "a", "--output", "b"], ["0.5", "nan", "--input", "a", "--output", "b"],
     ["0.5", "0.2", "0.1", "--input", "a"]],
)
def test_bad_arguments_stop_before_spark(argv):
    with pytest.raises(SystemExit):
        arguments(argv)


@pytest.mark.parametrize("staged", [False, True])
def test_run(spark, ngrams, tmp_path, staged):
    ngrams(*GOLDEN).write.parquet(str(tmp_path / "in"))
    argv = ["0.37", "0.38", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")]
    if staged:
        argv += ["--stages", str(tmp_path / "stages"), "--output-format", "parquet"]
    main(argv)
    if staged:
        found = spark.read.parquet(str(tmp_path / "out")).orderBy("decade", "npmi")
        assert rows(found, "decade", "w1", "w2") == [(1990, "rain", "deer"), (1990, "snow", "fall")]
    else:
        lines = [r.value.split("\t")[:4] for r in spark.read.text(str(tmp_path / "out")).collect()]
        assert lines == [["1990", "snow", "fall", "Npmi"], ["1990", "rain", "deer", "Npmi"]]
