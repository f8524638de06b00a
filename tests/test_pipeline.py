"""Extraction, grouping, registry, outputs, sources, streaming, command line."""

from __future__ import annotations

import gzip
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from citeloom import cli
from citeloom.functions.jsonvalue import with_variant
from citeloom.operators.extraction import candidate_citations, citations_of, document_references, document_status, explode_items, explode_references, extract_citations, extraction_stats, match_references, parse_files, reference_counters
from citeloom.operators.grouping import dedup_citations, grouped_citations, of_provenance, record_json, with_work_flags, work_counts
from citeloom.operators.registry import failed_works, index_of, registry_ids, registry_stats, unfinished, valid_works, with_validity
from citeloom.operators.statistics import aggregation_stats
from citeloom.plans import pipeline
from citeloom.plans.pipeline import build_index, run_pipeline
from citeloom.plans.progress import Progress
from citeloom.session import materialize, scratch, shared_dir
from citeloom.sinks.selection import Output, input_stem, log_level, output_paths, parse_outputs
from citeloom.sinks.writers import rows_per_file, write_staged
from citeloom.sources.detect import RegistryInput, WorksInput, detect_registry, detect_works
from citeloom.sources.inputs import count_rows, file_order, read_registry_lines, read_staged, read_works, staged_parts
from citeloom.streaming.incremental import ingest, read_ingested, read_manifest, retry_failed
from tests.conftest import rows

FIRST = {
    "items": [
        {"DOI": "10.1/A", "reference": [{"DOI": "10.48550/arXiv.2403.00001", "doi-asserted-by": "publisher"}, {"unstructured": "arXiv:2403.00002v3"}, "text", {"unstructured": "ArXiv without id"}, {"key": "x"}, {"journal-title": "arXiv", "unstructured": "2401.00001 (2024)"}]},
        {"reference": [{"unstructured": "arXiv:2403.00009"}]},
        {"DOI": "10.48550/ARXIV.2403.00007", "reference": [{"unstructured": "arXiv:2403.00007 and arXiv:2403.00001"}, {"DOI": "10.48550/arXiv.2403.00001v2", "doi-asserted-by": "crossref"}]},
    ]
}
WANT = [("10.1/a", 0, "2403.00001", "publisher"), ("10.1/a", 1, "2403.00002", "mined"), ("10.1/a", 5, "2401.00001", "mined"), ("10.48550/arxiv.2403.00007", 0, "2403.00001", "mined"), ("10.48550/arxiv.2403.00007", 1, "2403.00001", "mined")]


def _frame(spark, docs):
    return spark.createDataFrame([(f"{i}.json", d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "file_name string, value string")


def _short(df):
    return sorted((r.citing_doi, r.ref_index, r.cited_id.removeprefix("10.48550/arXiv."), r.provenance) for r in df.collect())


def test_extraction(spark):
    files = _frame(spark, [FIRST, "{not json", None, ""])
    assert _short(extract_citations(files)) == sorted(WANT)
    assert _short(extract_citations(files, ["PUBLISHER"])) == [WANT[0]]
    assert extract_citations(files, ["unknown"]).count() == 0
    stats = extraction_stats(files, ["mined"]).first().asDict()
    assert stats == {"files": 4, "files_failed": 3, "items": 3, "refs_unparseable": 1, "no_match": 1, "filtered_self_cite": 1, "filtered_provenance": 1, "extracted": 4}
    assert extract_citations(files.limit(0)).count() == 0
    assert extraction_stats(files.limit(0)).first().asDict()["files"] == 0


@pytest.mark.parametrize(
    ("doc", "fails"),
    [
        ("{}", False), ('{"items":[]}', False), ('{"items":[{"DOI":null}]}', False), ('{"items":[{}]}', False), ('{"other":1}', False),
        ('{"items":null}', True), ('{"items":{}}', True), ('{"items":[1]}', True), ('{"items":[{"DOI":5}]}', True), ('{"items":[{"reference":null}]}', True), ('{"items":[{"reference":{}}]}', True), ("[]", True), ("1", True), ('{"items":[]} x', True), ('{"items":[]}}', True), ("", True), (None, True),
        ('{"items":[{"reference":[1,null,"x",{"DOI":1}]}]}', False),
    ],
)
def test_whole_documents_fail(spark, doc, fails):
    assert parse_files(_frame(spark, [doc])).first().parse_failed is fails


def test_references_fail_alone(spark):
    refs = ["x", 1, None, [], {"DOI": 5}, {"URL": {}}, {"doi-asserted-by": True}, {"year": 5}, {"DOI": None}, {}]
    got = explode_references(explode_items(parse_files(_frame(spark, [{"items": [{"DOI": "", "reference": refs}]}]))))
    assert [r.parseable for r in got.orderBy("ref_index").collect()] == [False] * 7 + [True] * 3
    assert {r.citing_doi for r in got.collect()} == {""}


def test_match_counts_are_of_distinct_ids(spark):
    doc = {"items": [{"DOI": "a", "reference": [{"unstructured": "arXiv:2403.00002 arXiv:2403.00001 arXiv:2403.00002v2"}]}]}
    got = candidate_citations(match_references(explode_references(explode_items(parse_files(_frame(spark, [doc]))))))
    assert sorted(r.cited_id for r in got.collect()) == ["10.48550/arXiv.2403.00001", "10.48550/arXiv.2403.00002"]


def test_variant_is_strict(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1}}', '{"a":1},"end":"x"}', "[1,2]", "1,2", " null ", '{"a":1,"a":2}', "{'a':1}", "", None]
    got = with_variant(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), F.col("t"), "v").select("i", F.to_json("v").alias("j")).collect()
    assert {r.i: r.j for r in got} == {0: '{"a":1}', 1: None, 2: None, 3: None, 4: "[1,2]", 5: None, 6: "null", 7: '{"a":2}', 8: None, 9: None, 10: None}


ROWS = [("c", 0, "W1", "mined", "null"), ("a", 2, "W1", "publisher", '{"k":1}'), ("a", 1, "W1", "other", "bad"), ("b", 0, "W1", "crossref", "null"), ("a", 2, "W1", "mined", "null"), ("d", 0, "W2", None, None), (None, None, "W2", "mined", "null"), ("W2", 0, "W2", "mined", "null"), ("d", 0, None, "mined", "null")]


def _rows(spark, values=ROWS):
    return spark.createDataFrame(values, "citing_doi string, ref_index int, cited_id string, provenance string, ref_json string").withColumns({"rank": F.lit(9), "page_no": F.lit(9), "l": F.lit(1)})


def test_dedup_and_grouping(spark):
    citations = dedup_citations(_rows(spark))
    assert sorted((r.cited_id, r.citing_doi, r.ref_index, r.provenance) for r in citations.collect()) == [("", "d", 0, "mined"), ("W1", "a", 1, "other"), ("W1", "a", 2, "publisher"), ("W1", "b", 0, "crossref"), ("W1", "c", 0, "mined"), ("W2", "", 0, "mined"), ("W2", "d", 0, "mined")]
    grouped = grouped_citations(citations)
    work = grouped.where("cited_id = 'W1'").first()
    assert work.citation_count == 4 and [(c.provenance, c.doi, c.ref_index) for c in work.cited_by] == [("publisher", "a", 2), ("crossref", "b", 0), ("other", "a", 1), ("mined", "c", 0)]
    counts = {r.cited_id: (r.citation_count, r.publisher_count, r.crossref_count, r.mined_count) for r in work_counts(citations).collect()}
    assert counts == {"": (1, 0, 0, 1), "W1": (4, 1, 1, 2), "W2": (2, 0, 0, 2)}
    assert {r.cited_id: r.citation_count for r in of_provenance(grouped, "mined").collect()} == {"": 1, "W1": 2, "W2": 2}
    assert grouped_citations(dedup_citations(_rows(spark).limit(0))).count() == 0
    line = json.loads(grouped.where("cited_id = 'W1'").select(record_json(F.col("cited_id"), F.col("citation_count"), F.col("cited_by"))).first()[0])
    assert line["doi"] == "W1" and line["cited_by"][0] == {"doi": "a", "provenance": "publisher", "reference": {"k": 1}} and line["cited_by"][2]["reference"] is None


def test_pages_of_a_hot_work_hold_all(spark):
    frame = _rows(spark, [(f"c{i}", i % 3, "hot", "mined", "null") for i in range(500)] + [("x", 0, "cold", "mined", "null")])
    pages = grouped_citations(dedup_citations(frame), page=60).collect()
    hot = [p for p in pages if p.cited_id == "hot"]
    assert len(hot) > 5 and max(len(p.cited_by) for p in hot) < 120 and {p.citation_count for p in hot} == {500}
    assert sorted(c.doi for p in hot for c in p.cited_by) == sorted(f"c{i}" for i in range(500))
    assert [p.page_no for p in pages if p.cited_id == "cold"] == [0]


def test_pages_are_in_order_and_say_what_they_are(spark, monkeypatch):
    kinds = ["mined", "publisher", "crossref", "other"]
    values = [(f"c{i % 170}", i, "hot", kinds[i % 4], "null") for i in range(500)] + [(f"c{i}", 0, "warm", "mined", "null") for i in range(61)] + [(f"c{i}", 0, "full", "mined", "null") for i in range(60)] + [("x", 0, "cold", "mined", "null")]
    citations = dedup_citations(_rows(spark, values))
    whole = {r.cited_id: r.cited_by for r in grouped_citations(citations).collect()}
    for broadcast in (100_000, 0):  # hot works are salted where they are too many to be broadcast
        monkeypatch.setattr("citeloom.operators.grouping.BROADCAST_WORKS", broadcast)
        pages = grouped_citations(citations, page=60).orderBy("cited_id", "page_no").collect()
        assert [(p.cited_id, p.page_no, p.n_pages, len(p.cited_by)) for p in pages] == [("cold", 0, 1, 1), ("full", 0, 1, 60), *(("hot", i, 9, 60 if i < 8 else 20) for i in range(9)), ("warm", 0, 2, 60), ("warm", 1, 2, 1)]
        for work in whole:
            assert [c for p in pages if p.cited_id == work for c in p.cited_by] == whole[work]
    lines = grouped_citations(citations, page=60).select(record_json(F.col("cited_id"), F.col("citation_count"), F.col("cited_by"), F.col("page_no"), F.col("n_pages"))).collect()
    got = sorted((d["doi"], d.get("page"), d.get("pages"), d["citation_count"]) for d in (json.loads(r[0]) for r in lines) if d["doi"] in ("warm", "cold"))
    assert [g for g in got if g[0] == "cold"] == [("cold", None, None, 1)] and [g for g in got if g[0] == "warm"] == [("warm", 0, 2, 61), ("warm", 1, 2, 61)]


def test_flags_meet_every_page(spark):
    citations = dedup_citations(_rows(spark, [(f"c{i}", 0, "hot", "mined", "null") for i in range(130)] + [("x", 0, "cold", "mined", "null"), ("y", 0, None, "mined", "null")]))
    works = with_validity(work_counts(citations), spark.createDataFrame([("hot",)], "id string"))
    got = with_work_flags(grouped_citations(citations, page=60), works, page=60)
    assert sorted((r.cited_id, r.page_no, r.is_valid, len(r.cited_by)) for r in got.collect()) == [("", 0, False, 1), ("cold", 0, False, 1), ("hot", 0, True, 60), ("hot", 1, True, 60), ("hot", 2, True, 10)]


def test_provenance_counts_of_paged_works_are_the_works(spark):
    kinds = ["mined", "publisher", "mined", "crossref", "other"]
    frame = _rows(spark, [(f"c{i}", i % 3, "hot", kinds[i % 5], "null") for i in range(500)] + [("p", 9, "hot", "crossref", "null")] + [("x", 0, "cold", "mined", "null")])
    grouped = grouped_citations(dedup_citations(frame), page=60)
    for provenance, total in (("publisher", 100), ("crossref", 101), ("mined", 300)):
        pages = [p for p in of_provenance(grouped, provenance).collect() if p.cited_id == "hot"]
        assert {p.citation_count for p in pages} == {total} == {sum(len(p.cited_by) for p in pages)}
    assert [(p.cited_id, p.citation_count) for p in of_provenance(grouped, "mined").where("cited_id = 'cold'").collect()] == [("cold", 1)]


def test_registry(spark):
    lines = spark.createDataFrame([(x,) for x in ('{"id":"10.1/A"}', '{"id":"10.1/a","x":1}', '{"id":5}', '{"id":null}', '{"id":""}', "{}", "bad", '{"id":"10.1/b"} x', "[]", None)], "value string")
    assert rows(registry_ids(lines)) == [("10.1/a",)]
    assert registry_stats(lines).first().asDict() == {"lines": 10, "lines_skipped": 7, "ids": 1}
    works = spark.createDataFrame([("10.1/A", 1), ("10.1/z", 2), (None, 3)], "cited_id string, id int")
    index = index_of(spark.createDataFrame([("10.1/a",), ("10.1/A",), (None,), ("",)], "id string"), "id")
    assert index.count() == 1
    assert sorted((str(r.cited_id), r.is_valid) for r in with_validity(works, index).collect()) == [("10.1/A", True), ("10.1/z", False), ("None", False)]
    assert not with_validity(works, None).where("is_valid").count()
    assert [r.id for r in valid_works(works, index).collect()] == [1] and sorted(r.id for r in failed_works(works, index).collect()) == [2, 3]


def test_aggregation_stats(spark):
    works = spark.createDataFrame([("a", 3, 1, 0, 2, True), ("b", 5, 5, 0, 0, False), ("c", 1, 0, 0, 1, True)], "cited_id string, citation_count bigint, publisher_count bigint, crossref_count bigint, mined_count bigint, is_valid boolean")
    got = aggregation_stats(works).first().asDict()
    assert got == {"works": 3, "total_citations": 9, "valid_works": 2, "failed_works": 1, "publisher_works": 1, "publisher_citations": 1, "crossref_works": 0, "crossref_citations": 0, "mined_works": 2, "mined_citations": 3}
    assert aggregation_stats(works, False).first().mined_citations == 0 and aggregation_stats(works.limit(0)).first().works == 0


def test_selection():
    assert parse_outputs([]) == parse_outputs(["bad", "ALL"]) == set(Output)
    assert parse_outputs(["Valid", "mined"]) == {Output.VALID, Output.MINED}
    with pytest.raises(ValueError, match="Invalid output type"):
        parse_outputs(["valid", "bad"])
    assert [input_stem(p) for p in ("/x/s.tar.gz", "/x/dir/", "a.jsonl.gz", "b.jsonl", "c.json", "d")] == ["s", "dir", "a", "b", "c", "d"]
    assert output_paths([Output.FAILED], "/o/", "s") == {Output.FAILED: "/o/s_failed.jsonl"}
    assert [log_level(x) for x in ("warning", "debug", "odd")] == ["WARN", "DEBUG", "INFO"]
    assert rows_per_file(5_000_000) == 50_000 and rows_per_file(1) == 10_000


def test_detection(tmp_path):
    def make(name, *files):
        d = tmp_path / name
        d.mkdir()
        for f in files:
            (d / f).parent.mkdir(exist_ok=True)
            (d / f).write_text("{}")
        return str(d)

    assert detect_works(make("j", "1.json", "readme")) is WorksInput.JSON_DIRECTORY
    assert detect_works(make("f", "A.JSON") + "/A.JSON") is WorksInput.JSON_FILE
    assert detect_works(make("t", "a.TAR.gz") + "/a.TAR.gz") is WorksInput.TAR_GZ
    assert detect_registry(make("n", "updated_2024-01/p.jsonl.gz")) is RegistryInput.NESTED_SNAPSHOT
    assert detect_registry(make("l", "p.jsonl")) is RegistryInput.FLAT_DIRECTORY
    assert detect_registry(make("g", "p.jsonl.gz") + "/p.jsonl.gz") is RegistryInput.JSONL_GZ
    mixed = make("m", "1.json", "p.jsonl")
    for detect, path, message in ((detect_works, mixed, "Ambiguous"), (detect_registry, mixed, "Ambiguous"), (detect_works, make("e"), "no processable"), (detect_works, make("o", "x.txt"), "does not contain"), (detect_registry, make("p", "x.txt"), "does not contain"), (detect_works, make("q", "x.txt") + "/x.txt", "Unrecognized"), (detect_registry, mixed + "/1.json", "Unrecognized")):
        with pytest.raises(ValueError, match=message):
            detect(path)
    with pytest.raises(FileNotFoundError):
        detect_works(str(tmp_path / "none"))


def _archive(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))


def test_works_readers(spark, tmp_path):
    d = tmp_path / "d"
    d.mkdir()
    for n in ("1", "2", "10", "x"):
        (d / f"{n}.json").write_text(f'{{"items":\n[{{"DOI":"{n}"}}]}}')
    (d / "readme.txt").write_text("no")
    files = read_works(spark, str(d))
    assert [r.file_name for r in files.orderBy(*file_order("file_name")).collect()] == ["1.json", "2.json", "10.json", "x.json"]
    assert explode_items(parse_files(files)).count() == 4
    assert read_works(spark, str(d / "1.json")).count() == 1
    archive = str(tmp_path / "a.tar.gz")
    _archive(archive, {"a/0.json": json.dumps(FIRST), "a/readme": "no", "1.json": "{bad"})
    assert sorted(r.file_name for r in read_works(spark, archive).collect()) == ["1.json", "a/0.json"]
    assert _short(extract_citations(read_works(spark, archive))) == sorted(WANT)
    broken = tmp_path / "b.tar.gz"
    broken.write_bytes(open(archive, "rb").read()[:-40])
    with pytest.raises(Exception):  # noqa: B017
        read_works(spark, str(broken)).collect()


def test_registry_readers(spark, tmp_path):
    flat, nested = tmp_path / "flat", tmp_path / "nested" / "updated_2024-01"
    flat.mkdir()
    nested.mkdir(parents=True)
    with gzip.open(flat / "a.jsonl.gz", "wt") as f:
        f.write('{"id":"10.1/a"}\n\n  \n{"id":"10.1/b"}\n')
    (flat / "b.jsonl").write_text('{"id":"10.1/C"}\n')
    with gzip.open(nested / "a.jsonl.gz", "wt") as f:
        f.write('{"id":"10.1/n"}\n')
    (nested / "b.jsonl").write_text('{"id":"10.1/ignored"}\n')
    assert read_registry_lines(spark, str(flat)).count() == 3
    assert rows(registry_ids(read_registry_lines(spark, str(nested.parent)))) == [("10.1/n",)]
    assert read_registry_lines(spark, str(flat / "b.jsonl")).count() == 1


def test_run(spark, tmp_path):
    d, registry = tmp_path / "works", tmp_path / "r.jsonl"
    d.mkdir()
    (d / "1.json").write_text(json.dumps(FIRST))
    (d / "2.json").write_text("{bad")
    registry.write_text('{"id":"10.48550/arxiv.2403.00001"}\n')
    with pytest.raises(ValueError):
        run_pipeline(spark, str(d))
    with pytest.raises(ValueError, match="Invalid output"):
        run_pipeline(spark, str(d), registry=str(registry), outputs=["bad"])
    staging = str(tmp_path / "staged")
    result = run_pipeline(spark, str(d), registry=str(registry), output_dir=str(tmp_path), staging=staging)
    assert result.extraction["extracted"] == 5 and result.extraction["files_failed"] == 1
    assert result.aggregation["works"] == 3 and result.aggregation["valid_works"] == 1 and result.aggregation["total_citations"] == 5
    read = lambda o: [json.loads(r.value) for r in spark.read.text(result.outputs[o]).collect()]
    assert [(r["doi"], r["citation_count"]) for r in read(Output.VALID)] == [("10.48550/arXiv.2403.00001", 3)] and len(read(Output.FAILED)) == 2
    assert read(Output.PUBLISHER)[0]["citation_count"] == 1 and read(Output.MINED)[0]["citation_count"] == 2 and not read(Output.CROSSREF)
    index = str(tmp_path / "index")
    assert build_index(spark, str(registry), index) == 1
    again = run_pipeline(spark, staged=staging, index=index, outputs=["valid"], output_dir=str(tmp_path / "again"))
    assert again.extraction is None and again.aggregation["total_citations"] == 5 and set(again.outputs) == {Output.VALID}


def _works(tmp_path, n=6):
    d = tmp_path / "works"
    d.mkdir()
    for i in range(n):
        (d / f"{i}.json").write_text(json.dumps({"items": [{"DOI": f"10.1/{i}", "reference": [{"unstructured": f"arXiv:24{j:02d}.0000{j}"} for j in range(1, i + 2)]}]}))
    (d / "bad.json").write_text("{")
    registry = tmp_path / "r.jsonl"
    registry.write_text("".join(f'{{"id":"10.48550/arxiv.24{j:02d}.0000{j}"}}\n' for j in (1, 2, 3)))
    return str(d), str(registry)


def _lines(spark, path):
    return sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(path).collect())


def test_commits_give_what_one_run_gives(spark, tmp_path, monkeypatch):
    works, registry = _works(tmp_path)
    whole = run_pipeline(spark, works, registry=registry, output_dir=str(tmp_path / "a"))
    assert whole.staged is None  # staged rows of a run without a place for them are removed
    with pytest.raises(ValueError):
        run_pipeline(spark, works, registry=registry, resume=True)
    staging = str(tmp_path / "staged")
    args = {"registry": registry, "output_dir": str(tmp_path / "b"), "staging": staging, "checkpoint_interval": 2}
    # the run breaks off in its third commit
    calls, real = [], pipeline.aggregate

    def breaking(*a):
        calls.append(a)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*a)

    monkeypatch.setattr(pipeline, "aggregate", breaking)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, works, **args)
    assert os.path.exists(staging + "-progress/aggregation.json") and os.path.exists(staging + "-progress/extraction.json")
    monkeypatch.setattr(pipeline, "aggregate", lambda *a: (calls.append(a), real(*a))[1])
    monkeypatch.setattr(pipeline, "read_works", None)  # documents are not read again
    resumed = run_pipeline(spark, works, resume=True, **args)
    assert len(calls) == 4 and not os.path.exists(staging + "-progress")
    assert resumed.extraction == whole.extraction and resumed.aggregation == whole.aggregation
    for output in Output:
        assert _lines(spark, resumed.outputs[output]) == _lines(spark, whole.outputs[output])


def test_progress_is_whole(spark, tmp_path):
    path = str(tmp_path / "p" / "x.json")
    assert Progress.load(spark, path) == Progress()
    one = Progress().after(["a", "b"], {"works": 2}).after(["c"], {"works": 3})
    one.save(spark, path)
    one.save(spark, path)
    assert Progress.load(spark, path) == one and one.counters == {"works": 5} and one.commits == 2
    os.rename(path, path + ".tmp")  # as if the run had ended before its rename
    assert Progress.load(spark, path) == one
    (tmp_path / "p" / "x.json.tmp").write_text('{"parts')
    assert Progress.load(spark, path) == Progress()


def test_scratch_tables_are_removed(spark):
    frame = spark.range(3)
    with scratch(spark) as own:
        assert materialize(frame, "x").count() == 3 and os.path.isdir(own[0].removeprefix("file://"))
    assert not os.path.exists(own[0].removeprefix("file://"))


def test_without_a_shared_folder_only_local_runs(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)


def test_kinds_and_addresses(spark, tmp_path):
    works, registry = _works(tmp_path, 2)
    assert read_works(spark, f"file://{works}").count() == 3 and read_works(spark, works, WorksInput.JSON_DIRECTORY).count() == 3
    archives = tmp_path / "archives"
    archives.mkdir()
    for name in "ab":
        _archive(str(archives / f"{name}.tar.gz"), {f"{name}.json": json.dumps(FIRST)})
    assert sorted(r.file_name for r in read_works(spark, f"file://{archives}", WorksInput.TAR_GZ).collect()) == ["a.json", "b.json"]
    assert cli.parser().parse_args(["pipeline", "--input-kind", "tar_gz", "--registry-kind", "nested_snapshot"]).input_kind is WorksInput.TAR_GZ
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["pipeline", "--input-kind", "zip"])
    with pytest.raises(FileNotFoundError):
        read_works(spark, "file:///none/at/all")


def test_broken_registry_files_are_left_out(spark, tmp_path):
    d = tmp_path / "flat"
    d.mkdir()
    with gzip.open(d / "a.jsonl.gz", "wt") as f:
        f.write('{"id":"10.1/a"}\n')
    (d / "b.jsonl.gz").write_bytes(b"this is no gzip file at all")
    (d / "c.jsonl").write_text('{"id":"10.1/c"}\n')
    assert rows(registry_ids(read_registry_lines(spark, str(d)))) == [("10.1/a",), ("10.1/c",)]


def test_one_row_serves_rows_counters_and_status(spark):
    files = _frame(spark, [FIRST, "{not json", None, {}, {"items": []}, {"items": [{}, {"DOI": "x"}, {"DOI": "y", "reference": []}]}])
    refs = document_references(files)
    assert _short(citations_of(refs)) == sorted(WANT) and _short(citations_of(refs, ["publisher"])) == _short(extract_citations(files, ["publisher"]))
    assert refs.where("opens").count() == 6 and sorted(r.status for r in document_status(refs).collect()) == ["done"] * 4 + ["failed"] * 2
    assert reference_counters(refs).first().asDict() == {"files": 6, "files_failed": 2, "items": 6, "refs_unparseable": 1, "no_match": 1, "filtered_self_cite": 1, "filtered_provenance": 0, "extracted": 5}
    plan = extraction_stats(files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parse_json") == 1 or plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_staged_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staged(_rows(spark).select("citing_doi", "ref_index", F.lit("10.48550/arXiv.2403.1").alias("cited_id"), "provenance", "ref_json"), path)
    assert os.listdir(path + "/part=2403") and read_staged(spark, path, ["2403"]).count() == len(ROWS) == count_rows(spark, path)
    assert read_staged(spark, path, ["none"]).count() == 0
    odd = str(tmp_path / "odd")
    write_staged(_rows(spark).select("citing_doi", "ref_index", F.element_at(F.array(F.lit(""), F.lit("a:b%/c"), F.lit("10.1/x")), F.pmod(F.xxhash64("ref_json", "citing_doi"), F.lit(3)).cast("int") + 1).alias("cited_id"), "provenance", "ref_json"), odd)
    parts = staged_parts(spark, odd)
    assert set(parts) == {r.part for r in read_staged(spark, odd).select("part").distinct().collect()} and sum(read_staged(spark, odd, [p]).count() for p in parts) == len(ROWS)


def test_unfinished(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    manifest = spark.createDataFrame([("a", "done"), ("b", "failed")], "file_name string, status string")
    assert rows(unfinished(files, manifest)) == [("b",), ("c",)]


def test_incremental_ingest(spark, tmp_path):
    d = tmp_path / "works"
    d.mkdir()
    args = (spark, str(d), str(tmp_path / "staged"), str(tmp_path / "manifest"), str(tmp_path / "checkpoint"))
    (d / "1.json").write_text(json.dumps(FIRST))
    (d / "2.json").write_text("{bad")
    ingest(*args).awaitTermination(120)
    assert read_ingested(spark, args[2]).count() == 5
    assert rows(read_manifest(spark, args[3])) == [("1.json", "done"), ("2.json", "failed")]
    (d / "3.json").write_text(json.dumps({"items": [{"DOI": "10.9/x", "reference": [{"unstructured": "arXiv:2403.00003"}]}]}))
    ingest(*args).awaitTermination(120)
    assert read_ingested(spark, args[2]).count() == 6  # the first document was not read again
    (d / "2.json").write_text(json.dumps({"items": [{"DOI": "10.9/y", "reference": [{"unstructured": "arXiv:2403.00003"}]}]}))
    retry_failed(*args[:4], number=1)
    assert read_ingested(spark, args[2]).count() == 7 and {s for _, s in rows(read_manifest(spark, args[3]))} == {"done"}


def test_command_line(spark, tmp_path, capsys):
    registry = tmp_path / "r.jsonl"
    registry.write_text('{"id":"10.48550/arxiv.2403.00001"}\n')
    cli.main(["build-index", "-i", str(registry), "-o", str(tmp_path / "index"), "-l", "error"])
    assert "1 ids" in capsys.readouterr().out
    work = tmp_path / "w.json"
    work.write_text(json.dumps(FIRST))
    cli.main(["pipeline", "-i", str(work), "--index", str(tmp_path / "index"), "--outputs", "valid,failed", "--output-dir", str(tmp_path), "--staging-dir", str(tmp_path / "st"), "-l", "ERROR"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["aggregation"]["valid_works"] == 1
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["compare", "--ratio", "x"])
