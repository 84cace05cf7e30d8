"""``python -m tagshelf build|search|search-batch``: the batch job and searches from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators.embed import MAX_WORDS, NUM_PARTITIONS
from .operators.search import UnknownWordsError
from .plans.catalogue import build, prepare, search, search_batch
from .sources import read_delimited, write_delimited


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tagshelf")
    commands = parser.add_subparsers(dest="command", required=True)

    job = commands.add_parser("build", help="clean, embed and write a catalogue")
    job.add_argument("input", help="delimited text with a header, plain or gzip")
    job.add_argument("--min-partitions", type=int, help="tasks to spread the cleaned rows over; for few gzip files")
    job.add_argument("--drop-empty", action="store_true", help="drop the columns found empty, not a fixed list")
    job.add_argument("--country", default="fr")
    job.add_argument("--threshold", type=float, default=0.5)
    job.add_argument("--train", action="store_true", help="train the model instead of loading it")
    job.add_argument("--min-count", type=int, default=1, help="rows a word needs to be trained")
    job.add_argument("--max-words", type=int, default=MAX_WORDS, help="words the driver may hold while training")
    job.add_argument("--num-partitions", type=int, default=NUM_PARTITIONS, help="tasks that train")
    job.add_argument("--max-iter", type=int, default=1, help="passes of the training")
    job.add_argument("--clusters", type=int, help="clusters to store the products by, if --centres is given")
    job.add_argument("--model", required=True)

    query = commands.add_parser("search", help="show the products most similar to a text")
    query.add_argument("text")
    query.add_argument("--limit", type=int, default=10)

    batch = commands.add_parser("search-batch", help="search for every text of a file and write the results")
    batch.add_argument("queries", help="delimited text with the columns query_id and text")
    batch.add_argument("output", help="folder for the results, delimited text")
    batch.add_argument("--limit", type=int, default=10)

    for command in (job, batch):
        command.add_argument("--sep", default="\t")
        command.add_argument("--quote", default='"')
        command.add_argument("--escape", default='"', help="what stands before a quote inside a field")
        command.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    for command in (job, query, batch):
        command.add_argument("--products", required=True, help="embedded products (Parquet)")
        command.add_argument("--vectors", required=True, help="word vectors (Parquet)")
        command.add_argument("--centres", help="centres of the clusters the products are stored by (Parquet)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tagshelf").getOrCreate()
    if args.command == "build":
        raw = _read(spark, args.input, args)
        prepared = prepare(raw, args.country, args.threshold, drop_empty=args.drop_empty,
                           min_partitions=args.min_partitions)
        training = {"min_count": args.min_count, "num_partitions": args.num_partitions, "max_iter": args.max_iter,
                    "max_words": args.max_words}
        build(prepared, args.model, args.products, args.vectors, train=args.train,
              centres_path=args.centres, clusters=args.clusters, **training)
    elif args.command == "search":
        try:
            found = search(spark, args.text, args.products, args.vectors, args.limit, centres_path=args.centres)
        except UnknownWordsError as unknown:
            raise SystemExit(f"tagshelf: {unknown}") from None
        found.show(args.limit, truncate=False)
    else:
        queries = _read(spark, args.queries, args).select("query_id", "text")
        found = search_batch(queries, args.products, args.vectors, args.limit, centres_path=args.centres)
        write_delimited(found, args.output, args.sep)


def _read(spark: SparkSession, path: str, args: argparse.Namespace) -> DataFrame:
    return read_delimited(spark, path, args.sep, quote=args.quote, escape=args.escape, multi_line=args.multi_line)


if __name__ == "__main__":
    main()
