"""Sources under guard: broken ones are kept apart, whole."""

import pathlib

from roomledger.schema import BIGINT, STRING, struct
from roomledger.sources import guarded

SCHEMA = struct(id=BIGINT, name=STRING)


def test_broken_sources_are_kept_apart(spark, tmp_path):
    parquet, lines = guarded.parquet_reader(SCHEMA), guarded.json_reader(SCHEMA)
    sources = []
    for i in range(7):
        path = f"{tmp_path}/p{i}"
        spark.createDataFrame([(10 * i + j, "n") for j in range(5)], SCHEMA).coalesce(1).write.parquet(path)
        sources.append((path, parquet))
    cut = next(pathlib.Path(f"{tmp_path}/p3").glob("*.parquet"))
    cut.write_bytes(cut.read_bytes()[:-40])  # the footer is cut short
    for f in pathlib.Path(f"{tmp_path}/p3").glob(".*.crc"):
        f.unlink()
    texts = {"j0": '{"id": 100, "name": "a"}\n{"id": 101, "name": null}\n', "j1": '{"id": 102, "name": "b"}\n{"id": 103, "na', "j2": ""}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "lines.json").write_text(text)
        sources.append((f"{tmp_path}/{name}", lines))
    sources.append((f"{tmp_path}/missing", lines))
    kept, broken = guarded.union_guarded(spark, sources, f"{tmp_path}/staging")
    got = {(r["id"], r["source"].split("/")[-1]) for r in kept.collect()}
    assert got == {(10 * i + j, f"p{i}") for i in (0, 1, 2, 4, 5, 6) for j in range(5)} | {(100, "j0"), (101, "j0")}
    reasons = {r["source"].split("/")[-1]: r["reason"] for r in broken.collect()}
    assert reasons == {"p3": "FAILED_READ_FILE", "j1": "MALFORMED_RECORD_IN_PARSING", "missing": "PATH_NOT_FOUND"}
    assert all(r["message"] for r in broken.collect())


def test_nothing_to_read(spark, tmp_path):
    kept, broken = guarded.union_guarded(spark, [], f"{tmp_path}/a")
    assert kept is None and broken.count() == 0
    kept, broken = guarded.union_guarded(spark, [(f"{tmp_path}/none", guarded.parquet_reader(SCHEMA))], f"{tmp_path}/b")
    assert kept is None and broken.count() == 1
