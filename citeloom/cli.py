"""Command line: python -m citeloom.cli pipeline|build-index|compare ..."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.coverage import citation_samples, parse_ratio, sample_pairs, stratified_sample
from citeloom.plans.pipeline import build_index, compare, run_pipeline
from citeloom.session import build_session, materialize
from citeloom.sinks.selection import log_level
from citeloom.sinks.writers import summary_text, write_csv, write_summary
from citeloom.sources.detect import RegistryInput, WorksInput


def _list(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def _kind(kinds: type[Enum]):  # noqa: ANN202
    def parse(text: str) -> Enum:
        try:
            return kinds[text.upper()]
        except KeyError:
            raise ValueError(text) from None

    return parse


#: Tables of a comparison that a skip flag stands for, with their columns.
SKIPPABLE = {"openalex": "doi string, id string", "openalex-refs": "doi string, referenced_work string", "events": "doi string, subj_id string", "oc-refs": "citing_doi string, ref_pos int, cited string, oci string"}


def _skipped(a: argparse.Namespace, name: str) -> bool:
    return {"openalex": a.skip_openalex, "openalex-refs": a.skip_openalex, "events": a.skip_datacite, "oc-refs": a.skip_opencitations}[name]


def _or_empty(spark: SparkSession, path: str | None, skip: bool, columns: str) -> DataFrame:
    """A table, or an empty one where its comparison is skipped."""
    if skip:
        return spark.createDataFrame([], columns)
    if not path:
        raise SystemExit("a table of the comparison is missing, and it is not skipped")
    return spark.read.parquet(path)


def _pairs(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Pairs as they are, or every pair of published records with nested citations."""
    rows = spark.read.parquet(path)
    return citation_samples(rows, source) if "cited_by" in rows.columns else rows


def parser() -> argparse.ArgumentParser:
    """All commands and their options."""
    top = argparse.ArgumentParser(prog="citeloom", description="Citation graph of preprints from work documents")
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("pipeline", help="documents to outputs")
    p.add_argument("-i", "--input", help=".tar.gz, .json or a directory of .json files")
    p.add_argument("--registry", help="registry records: .jsonl, .jsonl.gz or a directory")
    p.add_argument("--index", help="index built with build-index; used where both are given")
    p.add_argument("--provenance", type=_list, default=[], help="publisher,crossref,mined; all by default")
    p.add_argument("--outputs", type=_list, default=[], help="all,valid,failed,publisher,crossref,mined")
    p.add_argument("--output-dir", default=".")
    p.add_argument("--partitions-dir", help="staged rows of an earlier run; nothing is extracted")
    p.add_argument("--staging-dir", help="where to stage rows and keep them")
    p.add_argument("--batch-size", type=int, default=5_000_000)
    p.add_argument("--input-kind", type=_kind(WorksInput), help=f"{', '.join(k.name.lower() for k in WorksInput)}; found out by default")
    p.add_argument("--registry-kind", type=_kind(RegistryInput), help=f"{', '.join(k.name.lower() for k in RegistryInput)}; found out by default")
    p.add_argument("--keep-intermediates", action="store_true", help="keep staged rows in the shared folder")
    p.add_argument("--resume", action="store_true", help="go on where a run with the same staging directory broke off")
    p.add_argument("--checkpoint-interval", type=int, default=0, help="directories of staged rows to aggregate between two records of progress; 0 aggregates all at once")
    b = commands.add_parser("build-index", help="registry records to an index")
    b.add_argument("-i", "--input", required=True)
    b.add_argument("-o", "--output", required=True)
    b.add_argument("--registry-kind", type=_kind(RegistryInput))
    c = commands.add_parser("compare", help="sampled pairs against tables of other sources")
    c.add_argument("--asserted", required=True, help="Parquet of pairs with an asserted DOI, or of published records")
    c.add_argument("--mined", required=True, help="Parquet of mined pairs, or of published records")
    c.add_argument("--works", required=True, help="Parquet of works")
    for name, columns in SKIPPABLE.items():
        c.add_argument(f"--{name}", help=f"Parquet of {name}")
    for name in ("openalex", "datacite", "opencitations"):
        c.add_argument(f"--skip-{name}", action="store_true", help=f"leave the {name} columns at false and NULL")
    c.add_argument("--sample", type=int, required=True)
    c.add_argument("--ratio", type=parse_ratio)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--output-csv", required=True)
    c.add_argument("--output-json", required=True)
    for command in (p, b, c):
        command.add_argument("-l", "--log-level", type=log_level, default="INFO")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    """Run one command."""
    a = parser().parse_args(arguments)
    spark = build_session()
    spark.sparkContext.setLogLevel(a.log_level)
    if a.command == "pipeline":
        result = run_pipeline(spark, a.input, registry=a.registry, index=a.index, provenance=a.provenance, outputs=a.outputs, output_dir=a.output_dir, staged=a.partitions_dir, staging=a.staging_dir, batch_size=a.batch_size, works_kind=a.input_kind, registry_kind=a.registry_kind, resume=a.resume, checkpoint_interval=a.checkpoint_interval, keep_intermediates=a.keep_intermediates)
        print(json.dumps({"outputs": {o.value: p for o, p in result.outputs.items()}, "extraction": result.extraction, "aggregation": result.aggregation}))
    elif a.command == "build-index":
        print(build_index(spark, a.input, a.output, a.registry_kind), "ids")
    else:
        asserted, mined = _pairs(spark, a.asserted, "asserted"), _pairs(spark, a.mined, "mined")
        samples = stratified_sample(asserted, mined, a.sample, a.ratio, a.seed) if a.ratio else sample_pairs(asserted.unionByName(mined), a.sample, a.seed)
        samples = materialize(samples, "samples")  # drawn once; each comparison reads it
        results, summary = compare(samples, spark.read.parquet(a.works), *(_or_empty(spark, getattr(a, n.replace("-", "_")), skip, columns) for n, columns in SKIPPABLE.items() for skip in [_skipped(a, n)]))
        unasked = [f"{n}_error" for n, skip in (("openalex", a.skip_openalex), ("datacite", a.skip_datacite), ("opencitations", a.skip_opencitations)) if skip]
        results = results.withColumns({c: F.lit(None).cast("string") for c in unasked})
        write_csv(results, a.output_csv)
        write_summary(summary, a.output_json)
        print(summary_text(summary))


if __name__ == "__main__":
    main()
