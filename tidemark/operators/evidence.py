"""Hashes, manifests, sealing and publishing of a completed session. Tables are checked by aggregates; only counts and hashes reach the driver."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import re
import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import close_utc, is_session
from ..functions.text import utc_time
from ..schemas import MARKET_DATASETS, METADATA_COLUMNS, SCHEMAS, known_at
from ..sources.archive import Archive, as_utc
from .normalize import data_bearing

SAFE_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
SHA256 = re.compile(r"[0-9a-f]{64}")
LEAST_COVERAGE = 0.95
ANALYST = ["recommendations", "analyst_price_targets", "estimates", "upgrades_downgrades", "profile", "earnings", "holders", "shares_outstanding"]
BLOCK = 4 * 1024 * 1024


class SealError(RuntimeError):
    """A bundle doesn't meet its contract; nothing was written."""


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)


def identity(manifest: dict, own_key: str = "identity_sha256") -> str:
    """SHA-256 of a manifest without its own hash."""
    return hashlib.sha256(canonical_json({k: v for k, v in manifest.items() if k != own_key}).encode()).hexdigest()


def schema_hash(df: DataFrame) -> str:
    """SHA-256 over names, Spark types and nullability."""
    return hashlib.sha256(canonical_json([{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema.fields]).encode()).hexdigest()


def table_hash(df: DataFrame, keys: Sequence[str], ranges: int = 256) -> str:
    """Content hash of a table that doesn't depend on files or order of rows: row hashes are folded by ranges of their keys' hash, then the ranges in order.

    A range folds by sums of four 62-bit parts of the row hashes, so that no list of hashes is ever gathered.
    """
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]), 256)
    parts = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    at = F.pmod(F.xxhash64(*keys), F.lit(ranges))
    folded = df.select(at.alias("r"), row.alias("h")).groupBy("r").agg(F.count("*").alias("n"), *[F.sum(p).alias(f"p{i}") for i, p in enumerate(parts)]).orderBy("r").collect()
    return hashlib.sha256(canonical_json([[int(x or 0) for x in r] for r in folded]).encode()).hexdigest()


def local_sha256(path: Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def file_hashes(spark: SparkSession, root: Path, paths: Sequence[str]) -> list[dict]:
    """path, bytes, sha256 of files under root, in order of path. Executors read them, block by block; only the hashes come back."""
    base = str(Path(root).resolve())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = [Path(base) / p for p in pdf["path"]]
            yield pd.DataFrame({"path": pdf["path"], "bytes": [p.stat().st_size for p in at], "sha256": [local_sha256(p) for p in at]})

    if not paths:
        return []
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    return sorted((r.asDict() for r in listed.mapInPandas(run, "path string, bytes long, sha256 string").collect()), key=lambda r: r["path"])


def block_hash(data: bytes, block: int = BLOCK) -> str:
    """Hash of the hashes of blocks, as block stores prove uploads."""
    return hashlib.sha256(b"".join(hashlib.sha256(data[i : i + block]).digest() for i in range(0, len(data), block))).hexdigest()


def write_atomic(path: Path, data: bytes) -> None:
    """Aside, flushed to disk, then renamed."""
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=path.parent, prefix=".tmp-")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(tmp, path)
    except BaseException:
        Path(tmp).unlink(missing_ok=True)
        raise


def write_json(path: Path, value: dict) -> None:
    write_atomic(path, (json.dumps(value, sort_keys=True, indent=2, allow_nan=False) + "\n").encode())


def read_json(path: Path) -> dict:
    """An object without repeated keys."""

    def pairs(items: list[tuple[str, object]]) -> dict:
        out = dict(items)
        if len(out) != len(items):
            raise SealError(f"{path} repeats a key")
        return out

    value = json.loads(path.read_text(encoding="utf-8"), object_pairs_hook=pairs)
    if not isinstance(value, dict):
        raise SealError(f"{path} holds no object")
    return value


def capture(folder: Path, name: str, content: bytes) -> dict:
    """Raw bytes, gzipped without a time stamp, with the hashes of both forms."""
    stored = gzip.compress(content, 9, mtime=0)
    write_atomic(folder / f"{name}.gz", stored)
    return {"path": f"{name}.gz", "source_sha256": hashlib.sha256(content).hexdigest(), "stored_sha256": hashlib.sha256(stored).hexdigest(), "source_bytes": len(content), "stored_bytes": len(stored)}


def capture_intact(folder: Path, entry: dict) -> bool:
    stored = (folder / entry["path"]).read_bytes()
    return hashlib.sha256(stored).hexdigest() == entry["stored_sha256"] and hashlib.sha256(gzip.decompress(stored)).hexdigest() == entry["source_sha256"]


def schema_errors(archive: Archive, dataset: str, day: str) -> tuple[list[str], list[str], str]:
    """Core columns that a partition's files lack, those they hold with another type, and the hash of the schema as stored."""
    stored = archive.spark.read.option("mergeSchema", "true").parquet(f"{archive.root}/{dataset}/date={day}")
    have = {f.name: f.dataType for f in stored.schema.fields}
    core = SCHEMAS[dataset].fields
    return [f.name for f in core if f.name not in have], [f.name for f in core if f.name in have and have[f.name] != f.dataType], schema_hash(stored)


def _iso(micros: int | None) -> str | None:
    return None if micros is None else (datetime(1970, 1, 1) + timedelta(microseconds=micros)).isoformat() + "Z"


def dataset_evidence(archive: Archive, dataset: str, day: str, expected: DataFrame | None) -> dict:
    """Rows, stored schema, time bounds and coverage of one partition, in one aggregate."""
    out = {"dataset": dataset, "rows": 0, "pit_column": known_at(dataset)}
    if day not in archive.dates(dataset):
        return out
    out["missing_core"], out["retyped_core"], out["schema_sha256"] = schema_errors(archive, dataset, day)
    df = archive.load(dataset, day, day, drop_no_coverage=False)
    at = utc_time(known_at(dataset))
    same = F.count_if(~F.col("dataset").eqNullSafe(F.lit(dataset))) if "dataset" in df.columns else F.lit(0)
    n, first, last, strange, untimed = df.agg(F.count("*"), F.min(F.unix_micros(at)), F.max(F.unix_micros(at)), same, F.count_if(at.isNull())).first()
    out |= {"rows": n, "columns": len(df.columns), "first_known_utc": _iso(first), "last_known_utc": _iso(last), "foreign_rows": strange, "untimed_rows": untimed}
    if expected is not None:
        with_data = data_bearing(df.where(~F.coalesce("no_analyst_coverage", F.lit(False))), METADATA_COLUMNS | {"snapshot_ts"}).select("symbol").distinct()
        wanted = expected.select("symbol").distinct()
        n_wanted = wanted.count()
        out["coverage"] = wanted.join(with_data, "symbol", "left_semi").count() / n_wanted if n_wanted else 0.0
    return out


@dataclass(frozen=True)
class Bundle:
    """A kind of bundle: where its manifest lies, where it is published, and which datasets and roles of files it must have."""

    schema: str
    folder: str
    base: str
    ready: str
    datasets: frozenset[str] = frozenset()
    roles: tuple[tuple[str, int, int | None], ...] = ()


ANALYST_BUNDLE = Bundle("tidemark_bundle_v1", "_bundles", "bundles", "ready")
FULL_BUNDLE = Bundle(
    "tidemark_full_bundle_v1", "_full_bundles", "full-bundles", "ready/full", frozenset([*ANALYST, *MARKET_DATASETS, "daily_prices"]),
    (("run manifest", 1, None), ("price manifest", 1, 1), ("context manifest", 1, 1), ("source", 1, None)),
)
PRICE_BUNDLE = Bundle("tidemark_price_bundle_v1", "_price_bundles", "price-bundles", "ready/prices", frozenset(["daily_prices"]), (("price manifest", 1, 1),))
BUNDLES = {b.schema: b for b in (ANALYST_BUNDLE, FULL_BUNDLE, PRICE_BUNDLE)}
#: Folder of a file -> its role; files of other folders are data
ROLES = {"_manifests": "run manifest", "_price_manifests": "price manifest", "_context_manifests": "context manifest", "_sources": "source"}
NO_PART = {b.folder for b in BUNDLES.values()} | {"_staging", "_price_checkpoints"}


def role_of(path: str) -> str:
    return ROLES.get(Path(path).parts[0], "data")


def partition_files(root: Path, day: str) -> list[str]:
    """Data, manifests and sources of one date, in order, below root; manifests of bundles and work in progress are no part of it."""
    found = (p for p in root.rglob("*") if p.is_file() and f"date={day}" in p.parts and not p.name.startswith((".", "_SUCCESS")))
    return sorted(r.as_posix() for p in found if (r := p.relative_to(root)).parts[0] not in NO_PART and not any(x.startswith("_replaced-") for x in r.parts))


def write_bundle(spark: SparkSession, root: Path, kind: Bundle, day: str, datasets: list[dict], paths: list[str], now: datetime, least: float, producer: dict | None) -> dict:
    """Hashes the files and writes the manifest, last of all."""
    if not paths:
        raise SealError("no files")
    files = [f | {"role": role_of(f["path"])} for f in file_hashes(spark, root, paths)]
    manifest = {"schema": kind.schema, "status": "complete", "date": day, "session_close_utc": close_utc(date.fromisoformat(day)).isoformat(), "sealed_utc": now.isoformat(), "least_coverage": least, "datasets": datasets, "files": files, "producer": producer or {}}
    manifest["identity_sha256"] = identity(manifest)
    manifest["generation"] = f"{day}-{manifest['identity_sha256'][:16]}"
    if wrong := rule_errors(manifest, kind):
        raise SealError("; ".join(wrong))
    write_json(root / kind.folder / f"date={day}" / "manifest.json", manifest)
    return manifest


def seal(archive: Archive, day: str, expected: DataFrame, required: Sequence[str] = tuple(ANALYST), now: datetime | None = None, least: float = LEAST_COVERAGE, producer: dict | None = None, full: bool = False) -> dict:
    """Check a completed session and write its manifest last; any failed check raises SealError and leaves none.

    With `full` the market feeds and prices belong to it too: prices and context are verified anew against their manifests, and a run manifest and raw sources must be there.
    """
    now = as_utc(now or datetime.now(UTC))
    d = date.fromisoformat(day)
    if not is_session(d):
        raise SealError(f"{day} is no session")
    close = close_utc(d)
    if close > now:
        raise SealError(f"{day} has not closed")
    if expected.isEmpty():
        raise SealError("the universe is empty")
    root, kind = Path(archive.root), FULL_BUNDLE if full else ANALYST_BUNDLE
    wanted = [*required]
    if full:
        from . import context, price_capture

        wanted = [*dict.fromkeys([*required, *MARKET_DATASETS, "daily_prices"])]
        wrong = [f"prices: {e}" for e in price_capture.verify(archive.spark, archive.root, d, expected, now, least)]
        at = root / "_context_manifests" / f"date={day}" / "manifest.json"
        wrong += [f"context: {e}" for e in (context.context_errors(archive, day, read_json(at), root / "_sources") if at.exists() else ["no manifest"])]
        if wrong:
            raise SealError("; ".join(wrong[:20]))
    evidence = []
    for name in wanted:
        e = dataset_evidence(archive, name, day, expected if name in ANALYST else None)
        if not e["rows"]:
            raise SealError(f"{name}: no rows")
        if e["missing_core"] or e["retyped_core"] or e["foreign_rows"] or e["untimed_rows"]:
            raise SealError(f"{name}: columns missing or of another type, rows of another dataset or without time: {e}")
        if as_utc(e["first_known_utc"]) < close:
            raise SealError(f"{name}: rows from before the close")
        if as_utc(e["last_known_utc"]) > now:
            raise SealError(f"{name}: rows from after the seal")
        if e.get("coverage", 1.0) < least:
            raise SealError(f"{name}: coverage {e['coverage']:.6f} is below {least}")
        evidence.append(e)
    paths = partition_files(root, day)
    return write_bundle(archive.spark, root, kind, day, evidence, paths if full else [p for p in paths if role_of(p) == "data"], now, least, producer)


MANIFEST_KEYS = {"schema", "status", "date", "session_close_utc", "sealed_utc", "least_coverage", "datasets", "files", "producer", "identity_sha256", "generation"}


def rule_errors(manifest: dict, kind: Bundle, producer: Callable[[dict], bool] | None = None) -> list[str]:
    """What is wrong with a manifest by itself: keys, times, identity, inventory, datasets and roles of its kind."""
    if set(manifest) != MANIFEST_KEYS:
        return [f"keys differ: {sorted(set(manifest) ^ MANIFEST_KEYS)}"]
    out = []
    if manifest["schema"] != kind.schema or manifest["status"] != "complete":
        out.append("schema or status")
    day, sealed = date.fromisoformat(manifest["date"]), as_utc(manifest["sealed_utc"])
    if not is_session(day) or as_utc(manifest["session_close_utc"]) != close_utc(day) or sealed < close_utc(day):
        out.append("session times")
    if not LEAST_COVERAGE <= manifest["least_coverage"] <= 1:
        out.append("threshold")
    if identity({k: v for k, v in manifest.items() if k != "generation"}) != manifest["identity_sha256"]:
        out.append("identity")
    if not SAFE_NAME.fullmatch(manifest["generation"]) or not manifest["generation"].startswith(manifest["date"]):
        out.append("generation")
    if producer and not producer(manifest["producer"]):
        out.append("producer")
    for e in manifest["datasets"]:
        known = e.get("first_known_utc"), e.get("last_known_utc")
        if not e.get("rows") or e.get("pit_column") != known_at(e.get("dataset", "")) or None in known or not close_utc(day) <= as_utc(known[0]) <= as_utc(known[1]) <= sealed:
            out.append(f"dataset {e.get('dataset')}")
    if not kind.datasets <= {e.get("dataset") for e in manifest["datasets"]}:
        out.append("datasets are missing")
    paths = [f["path"] for f in manifest["files"]]
    if not paths or paths != sorted(set(paths)):
        out.append("inventory is empty, unsorted or repeats a path")
    for f in manifest["files"]:
        parts = Path(f["path"]).parts
        if set(f) != {"path", "bytes", "sha256", "role"} or f["path"].startswith("/") or ".." in parts or parts[0] in NO_PART or [p for p in parts if p.startswith("date=")] != [f"date={manifest['date']}"] or not SHA256.fullmatch(f["sha256"]) or f["role"] != role_of(f["path"]):
            out.append(f"entry {f.get('path')}")
    for role, least, most in kind.roles:
        n = sum(f.get("role") == role for f in manifest["files"])
        if n < least or (most is not None and n > most):
            out.append(f"{n} files of role {role}")
    if kind is PRICE_BUNDLE and {f.get("role") for f in manifest["files"]} - {"data", "price manifest"} | {Path(p).parts[0] for p in paths} - {"daily_prices", "_price_manifests"}:
        out.append("files that are no prices")
    return out


def manifest_errors(manifest: dict, root: Path, producer: Callable[[dict], bool] | None = None, spark: SparkSession | None = None) -> list[str]:
    """What is wrong with a sealed manifest: its rules, then every file's place, size and hash (read by executors where a session is given)."""
    kind = BUNDLES.get(manifest.get("schema", ""), ANALYST_BUNDLE)
    if out := rule_errors(manifest, kind, producer):
        return out
    there = [f for f in manifest["files"] if (root / f["path"]).is_file() and not (root / f["path"]).is_symlink()]
    out = [f"file {f['path']}" for f in manifest["files"] if f not in there]
    hashes = file_hashes(spark, root, [f["path"] for f in there]) if spark else [{"path": f["path"], "bytes": (root / f["path"]).stat().st_size, "sha256": local_sha256(root / f["path"])} for f in there]
    got = {h["path"]: (h["bytes"], h["sha256"]) for h in hashes}
    return out + [f"file {f['path']}" for f in there if got[f["path"]] != (f["bytes"], f["sha256"])]


class FolderStore:
    """A remote store in a folder: immutable puts, overwriting pointers. Executors may put files, so it holds nothing but its root."""

    def __init__(self, root: Path):
        self.root = Path(root)

    def put(self, path: str, data: bytes, overwrite: bool = False) -> dict:
        at = self.root / path
        if at.exists() and not overwrite and at.read_bytes() != data:
            raise SealError(f"{path} is there with other content")
        write_atomic(at, data)
        return {"path": path, "bytes": len(data), "content_hash": block_hash(data)}

    def put_file(self, path: str, source: Path, overwrite: bool = False) -> dict:
        """Copies a file block by block; what comes back is computed from the blocks as they were written."""
        at = self.root / path
        if at.exists() and not overwrite and local_sha256(at) != local_sha256(source):
            raise SealError(f"{path} is there with other content")
        at.parent.mkdir(parents=True, exist_ok=True)
        fd, tmp = tempfile.mkstemp(dir=at.parent, prefix=".tmp-")
        size, whole, blocks = 0, hashlib.sha256(), b""
        try:
            with os.fdopen(fd, "wb") as to, open(source, "rb") as f:
                while data := f.read(BLOCK):
                    to.write(data)
                    size += len(data)
                    whole.update(data)
                    blocks += hashlib.sha256(data).digest()
                to.flush()
                os.fsync(to.fileno())
            os.replace(tmp, at)
        except BaseException:
            Path(tmp).unlink(missing_ok=True)
            raise
        return {"path": path, "bytes": size, "sha256": whole.hexdigest(), "content_hash": hashlib.sha256(blocks).hexdigest()}


def remote_path(path: str) -> str:
    """<dataset>/date=D/f to date=D/<dataset>/f."""
    parts = list(Path(path).parts)
    day = [p for p in parts if p.startswith("date=")]
    return "/".join(day + [p for p in parts if not p.startswith("date=")]) if len(day) == 1 else path


def _send(root: Path, pairs: list[tuple[str, str]], store: FolderStore, overwrite: bool, spark: SparkSession | None) -> dict[str, dict]:
    """Puts files (path below root, path in the store), by executors where a session is given: the store's answers by path below root."""
    base = str(Path(root).resolve())
    if spark is None or not pairs:
        return {a: store.put_file(b, Path(base) / a, overwrite) for a, b in pairs}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [store.put_file(b, Path(base) / a, overwrite) for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            yield pd.DataFrame(got).assign(a=pdf["a"].to_numpy())

    listed = spark.createDataFrame(pairs, "a string, b string").repartition(min(len(pairs), 4 * spark.sparkContext.defaultParallelism))
    return {r["a"]: r.asDict() for r in listed.mapInPandas(run, "path string, bytes long, sha256 string, content_hash string, a string").collect()}


def mirror(folder: Path, store: FolderStore, day: str | None = None, spark: SparkSession | None = None) -> int:
    """Copies dated files, of one date or all; how many."""
    found = [p.relative_to(folder).as_posix() for p in sorted(folder.rglob("*")) if p.is_file() and any(x.startswith("date=") if day is None else x == f"date={day}" for x in p.parts)]
    return len(_send(folder, [(p, remote_path(p)) for p in found], store, True, spark))


def publish(root: Path, day: str, store: FolderStore, kind: Bundle = ANALYST_BUNDLE, spark: SparkSession | None = None) -> dict:
    """Check the manifest and all files, then put data, manifest and, last, the READY pointer. Every put is proven by size and hash."""
    at = root / kind.folder / f"date={day}" / "manifest.json"
    manifest = read_json(at)
    if manifest.get("schema") != kind.schema:
        raise SealError("schema")
    if errors := manifest_errors(manifest, root, spark=spark):
        raise SealError("; ".join(errors))
    base = f"{kind.base}/{manifest['generation']}"
    where = {f["path"]: f"{base}/{remote_path(f['path'])}" for f in manifest["files"]}
    proofs = _send(root, list(where.items()), store, False, spark)
    for f in manifest["files"]:
        got = proofs[f["path"]]
        if (got["path"], got["bytes"], got["sha256"]) != (where[f["path"]], f["bytes"], f["sha256"]):
            raise SealError(f"{f['path']} arrived otherwise")
    store.put(f"{base}/manifest.json", at.read_bytes())
    ready = {"schema": "tidemark_ready_v1", "date": day, "bundle": kind.schema, "generation": manifest["generation"], "manifest_sha256": local_sha256(at)}
    store.put(f"{kind.ready}/date={day}.json", (canonical_json(ready) + "\n").encode(), overwrite=True)
    return ready
