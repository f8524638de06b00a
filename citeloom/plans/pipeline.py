"""Whole runs: extraction to staged rows, aggregation to outputs, the registry index, and the comparison."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from citeloom.operators.coverage import compare_summary, verify_contained, verify_events, verify_referenced_works, verify_references
from citeloom.operators.extraction import citations_of, document_references, reference_counters
from citeloom.operators.grouping import dedup_citations, grouped_citations, with_work_flags, work_counts
from citeloom.operators.registry import registry_ids, with_validity
from citeloom.operators.statistics import aggregation_stats
from citeloom.plans.progress import Progress, read_json, write_json
from citeloom.session import delete, materialize, scratch, scratch_path
from citeloom.sinks.selection import Output, input_stem, output_paths, parse_outputs
from citeloom.sinks.writers import write_index, write_records, write_staged
from citeloom.sources.detect import RegistryInput, WorksInput
from citeloom.sources.inputs import read_index, read_registry_lines, read_staged, read_works, staged_parts


@dataclass(frozen=True)
class RunResult:
    """What a run wrote and counted. extraction is None where staged rows were given; staged is None where they were removed."""

    outputs: dict[Output, str]
    staged: str | None
    extraction: dict[str, int] | None
    aggregation: dict[str, int]


def build_index(spark: SparkSession, registry: str, index: str, kind: RegistryInput | None = None) -> int:
    """Write the index of a registry; the number of its ids."""
    write_index(registry_ids(read_registry_lines(spark, registry, kind)), index)
    return read_index(spark, index).count()


def load_index(spark: SparkSession, index: str | None, registry: str | None, kind: RegistryInput | None = None) -> DataFrame | None:
    """The prebuilt index if there is one, else one made of the registry, else None."""
    if index:
        return read_index(spark, index)
    return materialize(registry_ids(read_registry_lines(spark, registry, kind)), "registry-ids") if registry else None


def aggregate(staged: DataFrame, index: DataFrame | None, outputs: dict[Output, str]) -> dict[str, int]:
    """Write the outputs of staged rows; the counters."""
    with scratch(staged.sparkSession):
        citations = materialize(dedup_citations(staged), "citations")
        works = materialize(with_validity(work_counts(citations), index), "work-counts")
        if outputs:
            write_records(materialize(with_work_flags(grouped_citations(citations), works), "works"), outputs)
        by_provenance = any(o.value in ("publisher", "crossref", "mined") for o in outputs)
        return aggregation_stats(works, by_provenance).first().asDict()


def aggregate_in_commits(spark: SparkSession, staged: str, index: DataFrame | None, outputs: dict[Output, str], progress: str, interval: int) -> dict[str, int]:
    """aggregate over groups of interval directories of staged rows, each a commit: what an earlier run committed is left as it is.

    A commit's lines go to a directory of its own below each output, and are replaced if it is repeated; then its
    directories and counters are recorded, by a rename. All counters are sums over commits, as every work is in one directory.
    """
    done = Progress.load(spark, progress)
    if done.commits == 0:
        for path in outputs.values():
            delete(spark, path)
    parts = [p for p in staged_parts(spark, staged) if p not in done.parts]
    for start in range(0, len(parts), interval):
        group = parts[start : start + interval]
        counted = aggregate(read_staged(spark, staged, group), index, {o: f"{p}/commit={done.commits:06d}" for o, p in outputs.items()})
        done = done.after(group, counted)
        done.save(spark, progress)
    if done.commits == 0:
        return aggregate(read_staged(spark, staged, []), index, outputs)
    delete(spark, progress)
    return done.counters


def run_pipeline(
    spark: SparkSession,
    works: str | None = None,
    *,
    registry: str | None = None,
    index: str | None = None,
    provenance: Sequence[str] = (),
    outputs: Iterable[str] = (),
    output_dir: str = ".",
    staged: str | None = None,
    staging: str | None = None,
    batch_size: int = 5_000_000,
    works_kind: WorksInput | None = None,
    registry_kind: RegistryInput | None = None,
    resume: bool = False,
    checkpoint_interval: int = 0,
    keep_intermediates: bool = False,
) -> RunResult:
    """Documents to outputs. With staged, the rows of an earlier run are taken and nothing is extracted.

    Arguments are checked before anything runs. Every document is read and parsed once: what rows and counters need of
    it is written to the shared folder. Staged rows are removed at the end unless staging names a place for them or they
    are to be kept. With checkpoint_interval, so many directories of staged rows are aggregated at a time, and what is
    finished is recorded under staging; with resume, a run that was broken off goes on there: extraction is left out where
    it was finished, and so are recorded directories.
    """
    if not (registry or index):
        raise ValueError("a registry or an index is needed")
    if not (works or staged):
        raise ValueError("works or staged rows are needed")
    if (resume or checkpoint_interval) and not (staging or staged):
        raise ValueError("to resume, a run needs a place for its staged rows")
    paths = output_paths(parse_outputs(outputs), output_dir, input_stem(works or staged))
    counted = None
    with scratch(spark) as own:
        ids = load_index(spark, index, registry, registry_kind)
        place = staged or staging or scratch_path(spark, "staged")
        kept = bool(staged or staging or keep_intermediates)
        if not kept:
            own.append(place)
        state = f"{place.rstrip('/')}-progress"
        if not staged:
            counted = read_json(spark, f"{state}/extraction.json") if resume else None
            if counted is None:
                delete(spark, state)
                references = materialize(document_references(read_works(spark, works, works_kind)), "references")
                write_staged(citations_of(references, provenance), place, batch_size)
                counted = reference_counters(references, provenance).first().asDict()
                if checkpoint_interval or resume:
                    write_json(spark, f"{state}/extraction.json", counted)
        if checkpoint_interval or resume:
            aggregated = aggregate_in_commits(spark, place, ids, paths, f"{state}/aggregation.json", max(1, checkpoint_interval))
            delete(spark, state)
        else:
            aggregated = aggregate(read_staged(spark, place), ids, paths)
    return RunResult(paths, place if kept else None, counted, aggregated)


def compare(samples: DataFrame, works: DataFrame, openalex: DataFrame, openalex_refs: DataFrame, events: DataFrame, oc_refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified pairs and their summary."""
    results = verify_contained(verify_events(verify_referenced_works(verify_references(samples, works), openalex, openalex_refs), events), oc_refs)
    return results, compare_summary(results)
