"""``spark-submit`` entry: ``python -m pairlore MIN_NPMI REL_MIN_NPMI --input ... --output ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pairlore.operators.scores import check_threshold
from pairlore.plans.pipeline import collocations, collocations_from, write_stages
from pairlore.sources.ngrams import FORMATS, ON_ERROR, read_ngrams
from pairlore.sources.sinks import write_by_decade, write_text


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pairlore", description=__doc__)
    parser.add_argument("min_npmi", type=lambda x: check_threshold("min_npmi", x))
    parser.add_argument("rel_min_npmi", type=lambda x: check_threshold("rel_min_npmi", x))
    parser.add_argument("--input", required=True, nargs="+", help="paths of one corpus")
    parser.add_argument("--format", default="parquet", choices=FORMATS)
    parser.add_argument("--on-error", default="fail", choices=ON_ERROR)
    parser.add_argument("--output", required=True, help="new directory for the result")
    parser.add_argument("--output-format", default="text", choices=("text", "parquet"))
    parser.add_argument("--stages", help="new shared directory for the stage tables")
    parser.add_argument("--stopword-mode", default="substring", choices=("substring", "exact"))
    parser.add_argument("--stop-words", help="file with one stop word per line, UTF-8")
    parser.add_argument("--sum-scope", default="positive", choices=("positive", "all"))
    parser.add_argument("--include-perfect", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("pairlore").getOrCreate()
    ngrams = read_ngrams(spark, args.input, args.format, args.on_error)
    thresholds = (args.min_npmi, args.rel_min_npmi)
    options = {"stopword_mode": args.stopword_mode, "sum_scope": args.sum_scope}
    if args.stop_words:
        options["stop_words"] = [r.value for r in spark.read.text(args.stop_words).collect()]
    if args.stages:
        stages = write_stages(ngrams, args.stages, **options)
        result = collocations_from(stages, *thresholds, include_perfect=args.include_perfect)
    else:
        result = collocations(
            ngrams, *thresholds, include_perfect=args.include_perfect, **options
        )
    if args.output_format == "text":
        write_text(result, args.output)
    else:
        write_by_decade(result, args.output)


if __name__ == "__main__":
    main()
