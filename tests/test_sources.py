import pytest
from pyspark.sql import functions as F

from pairlore import (
    as_facts,
    bigrams_of_text,
    collocations,
    contingency,
    count_facts,
    decade_totals,
    ngrams_from_text,
    npmi_scores,
    npmi_sums,
    pair_counts,
    parse_ngram_lines,
    pivot_counts,
    read_count_facts,
    read_lines,
    read_ngrams,
    read_score_facts,
    rejected_facts,
    rejected_ngram_lines,
    union_facts,
    write_by_decade,
    write_facts,
    write_text,
    write_sequence_file,
)
from pairlore.sources.facts import read_tagged_facts

from conftest import GOLDEN, rows

LINES = [
    "rain deer\t1994\t4\t2",
    '" quoted\t1994\t7\t1',
    'say "hi\t1995\t1\t1',
    "snow fall\t2001\t5\t3",
]
PARSED = [
    ('" quoted', 1994, 7),
    ("rain deer", 1994, 4),
    ('say "hi', 1995, 1),
    ("snow fall", 2001, 5),
]


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def save(spark, lines, path, format="text"):
    df = lines_df(spark, lines)
    if format == "sequencefile":
        df.rdd.map(lambda r: (7, r.value)).saveAsSequenceFile(path)
    else:
        df.write.text(path)
    return path


@pytest.mark.parametrize("format", ["text", "csv", "sequencefile"])
def test_line_formats(spark, tmp_path, format):
    path = save(spark, LINES, str(tmp_path / "n"), format)
    found = read_ngrams(spark, path, format)
    assert found.columns == ["ngram", "year", "match_count"]
    assert sorted(rows(found)) == PARSED


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_columnar_formats(spark, ngrams, tmp_path, format):
    path = str(tmp_path / "n")
    ngrams(*GOLDEN).write.format(format).save(path)
    assert sorted(rows(read_ngrams(spark, path, format))) == sorted(rows(ngrams(*GOLDEN)))


def test_several_paths(spark, tmp_path):
    paths = [save(spark, LINES[:2], str(tmp_path / "a")), save(spark, LINES[2:], str(tmp_path / "b"))]
    assert sorted(rows(read_ngrams(spark, paths, "text"))) == PARSED


def test_several_sequence_files(spark, tmp_path):
    paths = [
        save(spark, LINES[:2], str(tmp_path / "a"), "sequencefile"),
        save(spark, LINES[2:], str(tmp_path / "b"), "sequencefile"),
    ]
    assert sorted(rows(read_ngrams(spark, paths, "sequencefile"))) == PARSED


def test_long_and_short_sequence_values_do_not_mix(spark, tmp_path):
    lines = ["x" * 500 + " deer\t1994\t1", "rain deer\t1994\t2", "ש" * 40 + " fall\t1994\t3"]
    path = save(spark, lines, str(tmp_path / "n"), "sequencefile")
    assert sorted(r.value for r in read_lines(spark, path, "sequencefile").collect()) == sorted(lines)


def test_sequence_values_stay_records_with_line_ends(spark, tmp_path):
    values = ["rain\ndeer\t1994\t1", "snow\r\nfall\t1995\t2", "ice\rage\t1996\t3"]
    path = str(tmp_path / "records")
    spark.sparkContext.parallelize(list(enumerate(values)), 2).saveAsSequenceFile(path)
    lines = read_lines(spark, path, "sequencefile")
    assert "Scan ExistingRDD" in lines._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.value for r in lines.collect()) == sorted(values)
    found = sorted(rows(read_ngrams(spark, path, "sequencefile")))
    assert found == [("ice\rage", 1996, 3), ("rain\ndeer", 1994, 1), ("snow\r\nfall", 1995, 2)]


def test_sequence_file_reading_writes_no_copy(spark, tmp_path):
    import os
    from urllib.parse import urlparse

    from pairlore.sources.scratch import shared_folder

    path = save(spark, ["rain deer\t1994\t2"], str(tmp_path / "n"), "sequencefile")
    scratch = os.path.dirname(urlparse(shared_folder(spark)).path)
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert read_lines(spark, path, "sequencefile").count() == 1
    after = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert after == before


def test_unknown_format_and_mode(spark):
    with pytest.raises(ValueError):
        read_ngrams(spark, "x", "avro")
    with pytest.raises(ValueError):
        read_lines(spark, "x", "avro")
    with pytest.raises(ValueError):
        parse_ngram_lines(lines_df(spark, LINES), "ignore")


@pytest.mark.parametrize("bad", ["rain deer\tx\t4", "rain deer\t1994", "one\t1994\tx", "", "a\t\t1"])
def test_bad_line_fails_even_when_its_ngram_is_dropped(spark, bad):
    table = parse_ngram_lines(lines_df(spark, [*LINES, bad]))
    with pytest.raises(Exception, match="not an n-gram line"):
        pair_counts(table).collect()


def test_quarantine(spark):
    bad = ["rain deer\tx\t4", "rain deer\t1994", ""]
    lines = lines_df(spark, [*LINES, *bad])
    assert sorted(rows(parse_ngram_lines(lines, "quarantine"))) == PARSED
    assert sorted(r.value for r in rejected_ngram_lines(lines).collect()) == sorted(bad)


def test_csv_lines_of_any_length(spark, tmp_path):
    """Three, four and five fields, and bad lines: what text reads, csv reads."""
    good = ["rain deer\t1994\t4", "rain fall\t1994\t6\t2", "snow fall\t1994\t5\t1\tmore"]
    bad = ["rain deer\tx\t4", "rain deer\t1994", ""]
    path = save(spark, [*good, *bad], str(tmp_path / "n"))
    found = [sorted(rows(read_ngrams(spark, path, f, "quarantine"))) for f in ("csv", "text")]
    assert found[0] == found[1] and [r[0] for r in found[0]] == ["rain deer", "rain fall", "snow fall"]
    lines = read_lines(spark, path, "csv")
    assert sorted(r.value for r in rejected_ngram_lines(lines).collect()) == sorted(bad)


def test_csv_options(spark, tmp_path):
    lines = ['"rain, deer",1994,4', "snow fall,1994,5,1,more", "bad,x,1"]
    path = save(spark, lines, str(tmp_path / "n"))
    options = {"sep": ",", "quote": '"'}
    found = read_ngrams(spark, path, "csv", "quarantine", **options)
    assert sorted(rows(found)) == [("rain, deer", 1994, 4), ("snow fall", 1994, 5)]
    rejected = rejected_ngram_lines(read_lines(spark, path, "csv"), **options)
    assert [r.value for r in rejected.collect()] == ["bad,x,1"]
    with pytest.raises(ValueError):
        read_ngrams(spark, path, "csv", multiLine="true")


def test_sequence_files_stay_in_the_jvm(spark, tmp_path):
    write_sequence_file(lines_df(spark, LINES), str(tmp_path / "n"))
    found = read_ngrams(spark, str(tmp_path / "n"), "sequencefile")
    assert sorted(rows(found)) == PARSED
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan  # records are read, converted and typed in the JVM


@pytest.mark.parametrize("word", ["a\tb", "a\nb", " "])
def test_facts_that_no_line_can_hold(spark, tmp_path, word):
    facts = spark.createDataFrame([(1990, word, "c", "Cw1w2", 1)], "decade bigint, w1 string, w2 string, tag string, value bigint")
    with pytest.raises(Exception, match="no line can hold this fact"):
        write_facts(facts, str(tmp_path / "f"))


def test_facts_without_a_value(spark, tmp_path):
    facts = spark.createDataFrame([(None, "a", "c", "Cw1w2", 1)], "decade bigint, w1 string, w2 string, tag string, value bigint")
    with pytest.raises(Exception, match="no line can hold this fact"):
        write_facts(facts, str(tmp_path / "f"))


def test_csv_bad_number(spark, tmp_path):
    path = save(spark, [*LINES, "one\tx\t1\t1"], str(tmp_path / "n"))
    with pytest.raises(Exception):
        pair_counts(read_ngrams(spark, path, "csv")).collect()


def test_count_facts_round_trip(spark, ngrams, tmp_path):
    counts = contingency(pair_counts(ngrams(*GOLDEN)))
    parts = [("Cw1w2", "c12"), ("Cw1", "c1"), ("Cw2", "c2")]
    paths = []
    for tag, column in parts:
        paths.append(str(tmp_path / tag))
        write_facts(as_facts(counts, tag, column), paths[-1])
    paths.append(str(tmp_path / "N"))
    write_facts(as_facts(decade_totals(pair_counts(ngrams(*GOLDEN))), "N", "n"), paths[-1])

    facts = read_count_facts(spark, paths)
    assert facts.where("tag = 'N'").collect() == [(1990, None, None, "N", 24)]
    assert sorted(rows(pivot_counts(facts))) == sorted(
        rows(counts, "decade", "w1", "w2", "c12", "c1", "c2")
    )
    assert sorted(rows(count_facts(counts))) == sorted(
        rows(facts.where("tag <> 'N'"))
    )
    raw = {r.value for r in spark.read.text(paths[-1]).collect()}
    assert raw == {"1990\t \t \tN\t24"}


def test_missing_tag_counts_as_zero(spark):
    facts = spark.createDataFrame(
        [(1990, "rain", "deer", "Cw1w2", 4), (1990, "rain", "deer", "Cw2", 9)],
        "decade bigint, w1 string, w2 string, tag string, value bigint",
    )
    assert rows(pivot_counts(union_facts(facts))) == [(1990, "rain", "deer", 4, 0, 9)]


def test_score_facts_round_trip(spark, ngrams, tmp_path):
    counts = contingency(pair_counts(ngrams(*GOLDEN)))
    write_facts(as_facts(npmi_scores(counts), "Npmi", "npmi"), str(tmp_path / "a"))
    write_facts(as_facts(npmi_sums(counts), "SumNpmis", "sum_npmi"), str(tmp_path / "b"))
    facts = read_score_facts(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    by_tag = {t: sorted(r.value for r in facts.where(F.col("tag") == t).collect())
              for t in ("Npmi", "SumNpmis")}
    assert by_tag["Npmi"] == sorted(r.npmi for r in npmi_scores(counts).collect())
    assert by_tag["SumNpmis"] == [r.sum_npmi for r in npmi_sums(counts).collect()]


def test_counts_and_scores_in_one_place(spark, tmp_path):
    path = save(spark, ["1990\train\tdeer\tCw1w2\t4", "1990\train\tdeer\tNpmi\t9.5E-4"],
                str(tmp_path / "f"))
    counts, scores = read_tagged_facts(spark, path)
    assert rows(counts) == [(1990, "rain", "deer", "Cw1w2", 4)]
    assert rows(scores) == [(1990, "rain", "deer", "Npmi", 9.5e-4)]


@pytest.mark.parametrize(
    "bad", ["1990\train\tdeer\tOther\t4", "x\train\tdeer\tCw1\t4", "1990\train\tdeer", "",
            "1990\train\tdeer\tCw1\t4.5"]
)
def test_bad_fact(spark, tmp_path, bad):
    path = save(spark, ["1990\train\tdeer\tCw1w2\t4", bad], str(tmp_path / "f"))
    with pytest.raises(Exception, match="not a tagged fact"):
        read_count_facts(spark, path).collect()
    assert rows(read_count_facts(spark, path, "quarantine")) == [(1990, "rain", "deer", "Cw1w2", 4)]
    assert [r.value for r in rejected_facts(spark.read.text(path)).collect()] == [bad]


def test_writing_twice_fails(spark, ngrams, tmp_path):
    facts = as_facts(decade_totals(pair_counts(ngrams(*GOLDEN))), "N", "n")
    write_facts(facts, str(tmp_path / "f"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_facts(facts, str(tmp_path / "f"))


def test_text_result_is_in_order(spark, ngrams, tmp_path):
    table = ngrams(*((n, c, y) for y in (1950, 1994) for n, c in GOLDEN))
    result = collocations(table, 0.0, 2)
    write_text(result, str(tmp_path / "r"))
    files = sorted((tmp_path / "r").glob("part-*.txt"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert lines == [f"{d}\t{a}\t{b}\tNpmi\t{v}" for d, a, b, v in rows(result)]
    assert len(lines) == 6


def test_by_decade_layout_spreads_one_decade_in_order(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false")
    many = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, 1980).otherwise(1990).cast("bigint").alias("decade"),
        F.concat(F.lit("w"), "id").alias("w1"),
        F.lit("x").alias("w2"),
        (F.xxhash64("id") % 1000 / 1000.0).alias("npmi"),
    )
    write_by_decade(many, str(tmp_path / "r"))
    found = []
    for decade in (1980, 1990):
        files = sorted((tmp_path / "r" / f"decade={decade}").glob("part-*.parquet"))
        for f in files:
            found += [(decade, r.npmi, r.w1) for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 2
    assert found == sorted(rows(many, "decade", "npmi", "w1"), key=lambda r: (r[0], -r[1], r[2]))


def test_bigrams_of_text(spark):
    texts = spark.createDataFrame(
        [(1, " rain  deer\n\train deer "), (2, "rain\rdeer"), (3, "alone"), (4, ""), (5, None)],
        "id bigint, text string",
    )
    year = F.lit(1994).cast("bigint")
    assert sorted(rows(bigrams_of_text(texts, "text", year, "id"))) == [
        (1, "deer", "rain", 1994, 1),
        (1, "rain", "deer", 1994, 1),
        (1, "rain", "deer", 1994, 1),
        (2, "rain", "deer", 1994, 1),
    ]
    table = ngrams_from_text(texts, "text", year, "id")
    assert sorted(rows(table, "ngram", "year", "match_count", "volume_count")) == [
        ("deer rain", 1994, 1, 1), ("rain deer", 1994, 3, 2)
    ]
    counted = pair_counts(table)
    assert sorted(rows(counted)) == sorted(rows(pair_counts(bigrams_of_text(texts, "text", year))))


def test_scratch_scope_leaves_only_the_result(spark):
    import os
    from urllib.parse import urlparse

    from pairlore.sources.scratch import Scratch, saved, shared_folder

    scratch = os.path.dirname(urlparse(shared_folder(spark)).path)
    listing = lambda: set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    before = listing()
    with Scratch(spark) as scope:
        first = saved(spark.range(100), "first")  # an operator's own table joins the scope
        second = scope.saved(first.selectExpr("id * 2 AS id"), "second")
        result = scope.result(second.where("id % 3 = 0"), "answer")
        assert len(listing() - before) == 3
    left = listing() - before
    assert len(left) == 1 and next(iter(left)).startswith("pairlore-answer-")
    assert result.count() == 34
    with pytest.raises(ZeroDivisionError):
        with Scratch(spark):
            saved(spark.range(3), "lost")
            1 / 0
    assert listing() - before == left
    kept = saved(spark.range(2), "outside")  # no scope: stays
    assert kept.count() == 2 and len(listing() - before) == 2
