"""Command line: ``spark-submit`` entry points for the jobs.

    python -m wordloom.jobs top-words CORPUS OUT --stopwords stop.txt -k 50
    python -m wordloom.jobs cooccurrence CORPUS OUT --vocabulary top.txt -d 2 --layout stripes
    python -m wordloom.jobs document-frequency CORPUS OUT --stopwords stop.txt
    python -m wordloom.jobs tfidf CORPUS OUT --df top_df.tsv --stopwords stop.txt

CORPUS is text files (one document each) or, with ``--format parquet``, a table.
OUT is a folder of tab-separated files, in key order, and must not exist; with
``--head N`` or ``--count`` nothing is written and the rows or their number are printed.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import plans, sinks, sources
from wordloom.sources.corpus import GRAINS


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("corpus")
    common.add_argument("out", nargs="?", help="not with --head or --count")
    common.add_argument("--format", choices=("text", "parquet"), default="text")
    common.add_argument("--grain", choices=GRAINS, default="doc", help="what a record is")
    common.add_argument("--max-line", type=int, help="skip lines of this many bytes or more")
    common.add_argument("--key", default="doc_id", help="key column of a parquet corpus")
    common.add_argument("--text", default="text", help="text column of a parquet corpus")
    common.add_argument("--stopwords", action="append", metavar="FILE", help="may be repeated")
    common.add_argument("--raw-stopwords", action="store_true", help="take list lines as they are")
    common.add_argument("--single-file", action="store_true", help="one file; needs -k or a corpus-wide matrix")
    common.add_argument("--head", type=int, metavar="N", help="print the first N rows instead of writing")
    common.add_argument("--count", action="store_true", help="print the number of rows instead of writing")

    top = argparse.ArgumentParser(add_help=False)
    top.add_argument("-k", type=int, help="keep the k largest, largest first")
    top.add_argument("--names-only", action="store_true", help="first column only")

    main = argparse.ArgumentParser(prog="wordloom.jobs")
    jobs = main.add_subparsers(dest="job", required=True)

    words = jobs.add_parser("top-words", parents=[common, top], help="word counts")
    words.add_argument("--case-sensitive", action="store_true")

    matrix = jobs.add_parser("cooccurrence", parents=[common], help="co-occurrence matrix")
    matrix.add_argument("-d", "--distance", type=int, help="default 1")
    matrix.add_argument("--vocabulary", metavar="FILE", help="default: the corpus's own top words")
    matrix.add_argument("--max-distance", type=int, metavar="D", help="every distance 1..D in one pass, column d")
    matrix.add_argument("-k", type=int, help="how many top words without a file (50)")
    matrix.add_argument("--parts", type=int, default=1, help="cut stripes into parts by neighbour")
    matrix.add_argument("--layout", choices=plans.LAYOUTS, default="pairs")
    matrix.add_argument("--by-record", action="store_true", help="one matrix per record")
    matrix.add_argument("--keep-isolated", action="store_true", help="stripes of words without neighbour")

    jobs.add_parser("document-frequency", parents=[common, top], help="records per stem")

    scores = jobs.add_parser("tfidf", parents=[common], help="scores of known stems")
    scores.add_argument("--df", metavar="FILE", help="TERM<tab>DF; default: the top stems")
    scores.add_argument("-k", type=int, help="how many top stems without a file (100)")
    scores.add_argument("--n-docs", type=int, default=10_000, help="0: count the records")
    return main


def checked(args: argparse.Namespace) -> argparse.Namespace:
    """Refuse options that would have no effect or have no bound."""

    def refuse(wrong: bool, message: str) -> None:
        if wrong:
            raise SystemExit(f"wordloom.jobs {args.job}: {message}")

    matrix = args.job == "cooccurrence"
    shown = args.head is not None or args.count
    refuse(args.head is not None and args.count, "--head or --count, not both")
    refuse((args.out is None) != shown, "give OUT, or --head or --count")
    refuse(args.raw_stopwords and not args.stopwords, "--raw-stopwords needs --stopwords")
    refuse(shown and args.single_file, "--single-file needs OUT")
    bounded = not args.by_record if matrix else args.job != "tfidf" and bool(args.k)
    refuse(args.single_file and not bounded, "--single-file needs -k or a corpus-wide matrix")
    if matrix:
        plain = args.layout == "pairs"
        refuse(args.vocabulary and args.k is not None, "-k or --vocabulary, not both")
        refuse(args.keep_isolated and plain, "--keep-isolated needs --layout stripes")
        refuse(args.parts != 1 and (plain or args.by_record or args.max_distance), "--parts needs corpus-wide stripes")
        refuse(args.max_distance and (args.by_record or args.keep_isolated), "--max-distance goes with neither option")
        refuse(args.max_distance and args.distance is not None, "-d or --max-distance, not both")
    if args.job == "tfidf":
        refuse(args.df and args.k is not None, "-k or --df, not both")
    return args


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "text":
        return sources.read_text(spark, args.corpus, args.grain, max_line=args.max_line)
    table = sources.read_table(spark, args.corpus, keys=(args.key,), text=args.text)
    return sources.records(
        table.withColumnRenamed(args.text, "text"), args.grain, max_line=args.max_line
    )


def _top(counts: DataFrame, key: str, n: str, args: argparse.Namespace) -> tuple[DataFrame, list]:
    """Largest first, names only, or everything in key order."""
    out = op.top_k(counts, args.k, key=key, n=n) if args.k else counts
    order = [F.desc(n), F.desc(key)] if args.k else [F.col(key)]
    return out, order


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    records = _records(spark, args)
    stop = None
    if args.stopwords:
        stop = sources.settled(sources.read_words(spark, *args.stopwords, raw=args.raw_stopwords))
    columns = None
    if args.job == "top-words":
        counts = op.word_counts(records, stopwords=stop, case_sensitive=args.case_sensitive)
        out, order = _top(counts, "word", "n", args)
        columns = ["word"] if args.names_only else None
    elif args.job == "document-frequency":
        counts = op.document_frequency(records, stopwords=stop)
        out, order = _top(counts, "term", "df", args)
        columns = ["term"] if args.names_only else None
    elif args.job == "cooccurrence":
        out, order = _matrix(spark, records, stop, args)
    else:
        if args.df:
            table = sources.read_df_table(spark, args.df)
        else:
            table = plans.top_terms(records, args.k or 100, stopwords=stop)
        out = op.tfidf(records, table, n_docs=args.n_docs or None, stopwords=stop)
        order = [c for c in out.columns if c != "score"]
        out = sinks.score_text(out)
    if args.count:
        print(out.count())
    elif args.head is not None:
        first = out.orderBy(*order).limit(args.head)
        for row in sinks.tsv_lines(first.select(columns or first.columns)).collect():
            print(row.value)
    else:
        sinks.write_tsv(out, args.out, *order, columns=columns, single_file=args.single_file)


def _matrix(
    spark: SparkSession, records: DataFrame, stop, args: argparse.Namespace
) -> tuple[DataFrame, list]:
    if args.vocabulary:
        vocabulary = sources.settled(sources.read_words(spark, args.vocabulary))
    else:
        vocabulary = sources.settled(plans.top_words(records, args.k or 50, stopwords=stop).select("word"))
    distance = 1 if args.distance is None else args.distance
    if args.max_distance:
        if args.layout == "pairs":
            return sinks.pair_text(op.pairs_sweep(records, vocabulary, args.max_distance, stopwords=stop)), ["d", "pair"]
        return sinks.stripe_text(op.stripes_sweep(records, vocabulary, args.max_distance, stopwords=stop)), ["d", "word"]
    keys = [c for c in records.columns if c != "text"] if args.by_record else []
    if args.layout == "pairs":
        call = op.pairs_by_record if args.by_record else op.pairs
        matrix = call(records, vocabulary, distance, stopwords=stop)
        return sinks.pair_text(matrix), [*keys, "pair"]
    if args.by_record:
        matrix = op.stripes_by_record(
            records, vocabulary, distance, stopwords=stop, keep_isolated=args.keep_isolated
        )
        return sinks.stripe_text(matrix), [*keys, "word"]
    matrix = op.stripes(
        records, vocabulary, distance, stopwords=stop, keep_isolated=args.keep_isolated, parts=args.parts
    )
    return sinks.stripe_text(matrix), ["word"] if args.parts == 1 else ["word", "part"]


def main(argv: list[str] | None = None) -> None:
    args = checked(parser().parse_args(argv))
    run(SparkSession.builder.appName(f"wordloom {args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
