"""From dump to records, and from records to a subgraph: a Python interface and a command line.

    python -m spindrift.plans.engine parse -i dump.xml.bz2 --output-data out/data --output-index out/index -e links
    python -m spindrift.plans.engine subgraph --input-data out/data -r "Paris" -d 2 -m depth-limited -o out/titles
    python -m spindrift.plans.engine page --input-data out/data --input-index out/index -t "Paris"
    python -m spindrift.plans.engine fetch -u https://host/dump.xml.bz2 -o dump.xml.bz2
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.operators import graph as g
from spindrift.operators.extract import EXTRACTORS, Extractor, extract
from spindrift.session import checkpoints, local_session
from spindrift.sources.dump import fetch, located, page_record, read_dump, read_page
from spindrift.sources.sinks import write_indexed, write_titles


def parse(spark: SparkSession, dump: str, data: str, index: str, extractor: str | Extractor = "links", files: int | None = None) -> None:
    """Scans, filters and extracts a dump into data files with indexes."""
    with located(spark, dump):
        write_indexed(extract(read_dump(spark, dump), extractor), data, index, files)


def numbered_links(spark: SparkSession, data: str) -> DataFrame:
    """(idx, title, links) of extracted link records; equal titles have one idx, and different ones never share one."""
    checkpoints(spark)
    rows = spark.read.text(data).select(page_record(F.col("value")).alias("r")).select("r.title", "r.links")
    index = rows.select("title").distinct().withColumn("idx", F.monotonically_increasing_id()).checkpoint()
    return rows.join(index, "title").select("idx", "title", "links")


def neighbourhood(spark: SparkSession, data: str, root: str, depth: float, method: str = "depth-limited", fanout: float | None = None, mode: str = g.DOCUMENTED) -> DataFrame:
    """(title): the subgraph around a root page of extracted links."""
    pages = numbered_links(spark, data)
    index = g.page_index(pages)
    return g.subgraph(g.edges(pages, index), index, root, depth, method, fanout, mode)


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spindrift", description=__doc__.split("\n")[0])
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("parse", help="extract records from a dump")
    p.add_argument("-i", "--input-file", required=True)
    p.add_argument("--output-data", required=True)
    p.add_argument("--output-index", required=True)
    p.add_argument("-e", "--extractor", choices=sorted(EXTRACTORS), required=True)
    p.add_argument("--files", type=int, help="data files; as many as the dump has splits, if not given")
    s = commands.add_parser("subgraph", help="the titles around a page")
    s.add_argument("--input-data", required=True)
    s.add_argument("-o", "--output-file", required=True)
    s.add_argument("-r", "--root-page", required=True)
    s.add_argument("-d", "--depth", type=float, required=True)
    s.add_argument("-m", "--method", choices=sorted(g.METHODS), default="depth-limited")
    s.add_argument("-f", "--fanout-factor", type=float)
    s.add_argument("--mode", choices=[g.DOCUMENTED, g.AS_COMPUTED], default=g.DOCUMENTED)
    l = commands.add_parser("page", help="one page's record")
    l.add_argument("--input-data", required=True)
    l.add_argument("--input-index", required=True)
    l.add_argument("-t", "--title", required=True)
    f = commands.add_parser("fetch", help="download a dump")
    f.add_argument("-u", "--url", required=True)
    f.add_argument("-o", "--output-file", required=True)
    for c in (p, s, l, f):
        c.add_argument("--threads", type=int, default=None, help="of a local session")
    return top


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session(a.threads)
    if a.command == "parse":
        parse(spark, a.input_file, a.output_data, a.output_index, a.extractor, a.files)
        return 0
    if a.command == "fetch":
        print(f"{fetch(spark, a.url, a.output_file)} bytes")
        return 0
    if a.command == "page":
        record = read_page(spark, a.input_data, a.input_index, a.title)
        print(f"no page is titled {a.title!r}" if record is None else record, file=sys.stderr if record is None else sys.stdout)
        return 0
    try:
        found = neighbourhood(spark, a.input_data, a.root_page, a.depth, a.method, a.fanout_factor, a.mode)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 0 if "is titled" in str(e) else 2  # a missing root is told, and no failure
    write_titles(found, a.output_file)
    return 0


if __name__ == "__main__":
    sys.exit(main())
