"""Winnowed fingerprints, and the persistent store they are looked up in.

A content is a text within a block (for rating actions: the day). It is cut into k-grams, hashed together with the block, and winnowed:
the least hash of every window stays, so that equal contents have equal fingerprints and every stretch they share leaves one.

The store is a folder that all workers share. Contents lie in buckets by block; in a bucket every accepted batch adds runs of files
that are never changed: a Bloom filter of the run's own size, sorted fingerprints, and the contents with their first rows. A content is
looked up in its bucket alone: fingerprints pass the filter or drop out, those that pass are found by bisection, contents too few of whose
fingerprints are known drop out, the rarest fingerprints that any covering content must share name the candidates, and each candidate's
shared fingerprints are counted. Files are read where the bisection touches them, so a batch doesn't pay for the history it doesn't meet.
Every FAN runs of one level are merged into one of the next, so that a bucket has few, however many batches there were.

A batch counts once the store's manifest names it; what an interrupted one left is never read, and it is simply taken up again.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

GRAM, WINDOW = 8, 4
#: Bits set per fingerprint in its 64-bit word of the filter, and fingerprints a word should hold.
BITS, PER_WORD = 4, 4
SUFFIX = ".run"
#: Buckets of a new store; one for every few gigabytes of contents that it will hold.
BUCKETS = 32
#: Runs of one level that are merged, postings a file holds before the next begins, characters hashed at a time.
FAN, FILE_POSTINGS, CHUNK = 8, 4_000_000, 1 << 20
ENTRY = pa.list_(pa.struct([("rid", pa.int64()), ("t", pa.int64()), ("clock", pa.bool_()), ("fg", pa.string())]))
CONTENTS = pa.schema([("akey", pa.string()), ("block", pa.int64()), ("fps", pa.list_(pa.int64())), ("entries", ENTRY)])
#: What is given of a stored content that covers an asked one
GIVEN = ["akey", "block", "entries"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] of them, then those from starts[1]."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _winnow(texts: Sequence[str], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = [t.ljust(GRAM, "\0") for t in texts]
    cp = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(t) for t in padded])
    start, grams = np.cumsum(size) - size, size - GRAM + 1
    h = np.full(len(cp) - GRAM + 1, 14695981039346656037, dtype=np.uint64)
    for j in range(GRAM):
        h = (h ^ cp[j : j + len(h)]) * np.uint64(1099511628211)
    at = _ranges(start, grams)
    all_h = np.full(len(cp) + WINDOW, np.iinfo(np.uint64).max, dtype=np.uint64)
    all_h[at] = _mix(h[at] ^ np.repeat(_mix(blocks.astype(np.int64).view(np.uint64) + np.uint64(1)), grams))
    least = all_h[: len(cp)]
    for j in range(1, WINDOW):  # between two texts lie GRAM - 1 places without a gram
        least = np.minimum(least, all_h[j : j + len(cp)])
    windows = np.maximum(1, grams - WINDOW + 1)
    fps, owner = least[_ranges(start, windows)].view(np.int64), np.repeat(np.arange(len(texts)), windows)
    order = np.lexsort((fps, owner))
    fps, owner = fps[order], owner[order]
    keep = np.ones(len(fps), dtype=bool)
    keep[1:] = (fps[1:] != fps[:-1]) | (owner[1:] != owner[:-1])
    return fps[keep], np.bincount(owner[keep], minlength=len(texts))


def fingerprints(texts: Sequence[str], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints of all texts in turn, each text's sorted and distinct, how many each has: one at least). Texts are read whole, some CHUNK characters at a time."""
    parts, first, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + GRAM
        if size > CHUNK or i == len(texts) - 1:
            parts.append(_winnow(texts[first : i + 1], blocks[first : i + 1]))
            first, size = i + 1, 0
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def bloom(fps: np.ndarray) -> np.ndarray:
    words = np.zeros(1 << max(0, int(np.ceil(np.log2(max(1, len(fps) / PER_WORD))))), dtype=np.uint64)
    at, mask = _places(fps, len(words))
    np.bitwise_or.at(words, at, mask)
    return words


def _places(fps: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    h = _mix(fps.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
    mask = np.zeros(len(fps), dtype=np.uint64)
    for i in range(BITS):
        mask |= np.uint64(1) << (h >> np.uint64(6 * i)) % np.uint64(64)
    return (h >> np.uint64(32)).astype(np.int64) & (words - 1), mask


class Folder:
    """Files of the shared folder, whether it is mounted or named by a URI."""

    def __init__(self, uri: str):
        if uri.startswith("file:"):
            uri = "/" + uri[5:].lstrip("/")
        self.fs, self.root = (pafs.LocalFileSystem(use_mmap=True), uri) if "://" not in uri else pafs.FileSystem.from_uri(uri)
        self.made: set[str] = set()

    def open(self, name: str):
        return self.fs.open_input_file(posixpath.join(self.root, name))

    def write(self, name: str, put: Callable) -> None:
        """Aside, then renamed, so that no half file is ever read."""
        path = posixpath.join(self.root, name)
        if (parent := posixpath.dirname(path)) not in self.made:
            self.fs.create_dir(parent, recursive=True)
            self.made.add(parent)
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(aside) as out:
            put(out)
        self.fs.move(aside, path)

    def names(self, folder: str, suffix: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(posixpath.join(self.root, folder), allow_not_found=True))
        return sorted(f"{folder}/{i.base_name}"[: -len(suffix)] for i in found if i.base_name.endswith(suffix))

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(posixpath.join(self.root, name)).type != pafs.FileType.NotFound

    def remove(self, folder: str) -> None:
        if self.exists(folder):
            self.fs.delete_dir(posixpath.join(self.root, folder))


def write_run(folder: Folder, name: str, contents: pa.Table) -> None:
    """One run's file of a bucket: three sizes, then filter, sorted fingerprints, their contents' numbers (each of whole eight bytes), contents."""
    contents = contents.combine_chunks()
    fps = contents["fps"].combine_chunks()
    flat, sizes = fps.flatten().to_numpy(), np.diff(fps.offsets.to_numpy())
    owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    order = np.argsort(flat, kind="stable")
    words = bloom(flat)
    table = pa.BufferOutputStream()
    with pa.ipc.new_file(table, contents.schema) as w:
        w.write_table(contents)
    parts = [np.array([len(words), len(flat), table.tell()], dtype=np.int64).tobytes(), words.tobytes(), flat[order].tobytes(), owner[order].tobytes(), table.getvalue()]
    folder.write(f"{name}{SUFFIX}", lambda out: [out.write(x) for x in parts])


class Run:
    """A run's file: the filter is read at once, the rest where it is needed (on a mounted folder the file is mapped, not copied)."""

    def __init__(self, folder: Folder, name: str):
        self.folder, self.name = folder, name
        with folder.open(f"{name}{SUFFIX}") as f:
            self.n_words, self.n, self.size = np.frombuffer(f.read(24), dtype=np.int64).tolist()
            self.words = np.frombuffer(f.read(8 * self.n_words), dtype=np.uint64)

    def _part(self, at: int, size: int) -> pa.Buffer:
        with self.folder.open(f"{self.name}{SUFFIX}") as f:
            f.seek(24 + 8 * self.n_words + at)
            return f.read_buffer(size)

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        both = np.frombuffer(self._part(0, 16 * self.n), dtype=np.int64)
        return both[: self.n], both[self.n :]

    def contents(self) -> pa.Table:
        return pa.ipc.open_file(pa.BufferReader(self._part(16 * self.n, self.size))).read_all()

    def passes(self, fps: np.ndarray) -> np.ndarray:
        at, mask = _places(fps, len(self.words))
        return self.words[at] & mask == mask

    def covering(self, fps: np.ndarray, owner: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """(asked content, coverage, stored content) for all stored contents that share at least `least` of an asked content's fingerprints. n: fingerprints of each asked content."""
        none = np.zeros(0, np.int64), np.zeros(0), CONTENTS.empty_table().select(GIVEN)
        need = np.maximum(1, np.ceil(least * n - 1e-9).astype(np.int64))
        on = np.flatnonzero(self.passes(fps))
        on = on[(np.bincount(owner[on], minlength=len(n)) >= need)[owner[on]]]
        if not len(on):
            return none
        sorted_fps, holder = self.postings()
        left = np.searchsorted(sorted_fps, fps[on], "left")
        df = np.searchsorted(sorted_fps, fps[on], "right") - left
        known = df > 0
        on, left, df = on[known], left[known], df[known]
        have = np.bincount(owner[on], minlength=len(n))
        alive = (have >= need)[owner[on]]
        on, left, df = on[alive], left[alive], df[alive]
        if not len(on):
            return none
        # A content that shares `need` of the `have` known ones shares one of any have - need + 1: the rarest name the candidates
        order = np.lexsort((df, owner[on]))
        own, left, df = owner[on][order], left[order], df[order]
        nth = np.arange(len(own)) - np.searchsorted(own, own, "left")
        rare = nth < (have - need + 1)[own]
        asked, c = np.repeat(own[rare], df[rare]), holder[_ranges(left[rare], df[rare])]
        pairs = np.unique(asked.astype(np.int64) << 32 | c)
        asked, c = pairs >> 32, pairs & 0xFFFFFFFF
        stored = self.contents()
        lists = stored["fps"].combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sizes = (offsets[c + 1] - offsets[c]).astype(np.int64)
        theirs, pair = flat[_ranges(offsets[c].astype(np.int64), sizes)], np.repeat(np.arange(len(c)), sizes)
        names = np.unique(fps)
        mine = np.sort(owner.astype(np.int64) * len(names) + np.searchsorted(names, fps))
        rank = np.minimum(np.searchsorted(names, theirs), len(names) - 1)
        code = asked[pair] * len(names) + rank
        shared = (names[rank] == theirs) & (mine[np.minimum(np.searchsorted(mine, code), len(mine) - 1)] == code)
        count = np.bincount(pair[shared], minlength=len(c))
        ok = count >= need[asked]
        return asked[ok], count[ok] / n[asked[ok]], stored.select(GIVEN).take(pa.array(c[ok]))


class Store:
    """What all committed batches brought. `runs` are folders of files by bucket; the manifest names those that count."""

    def __init__(self, uri: str, buckets: int = BUCKETS):
        self.uri, self.folder = uri, Folder(uri)
        made = {"buckets": buckets, "gram": GRAM, "window": WINDOW, "batches": 0, "runs": []}
        if self.folder.exists("store.json"):
            with self.folder.open("store.json") as f:
                made = json.loads(f.read().decode())
            if (made["gram"], made["window"]) != (GRAM, WINDOW):
                raise ValueError(f"{uri} was made with other fingerprints")
        self.buckets, self.batches, self.runs = made["buckets"], made["batches"], made["runs"]

    def commit(self, runs: list[str], batches: int) -> None:
        made = {"buckets": self.buckets, "gram": GRAM, "window": WINDOW, "batches": batches, "runs": runs}
        self.folder.write("store.json", lambda out: out.write(json.dumps(made).encode()))
        self.runs, self.batches = runs, batches

    def bucket(self, blocks: np.ndarray) -> np.ndarray:
        return np.mod(blocks, self.buckets)

    def files(self, bucket: int) -> Iterator[str]:
        for run in self.runs:
            yield from self.folder.names(f"{run}/{bucket}", SUFFIX)

    def merge(self, runs: list[str], into: str, bucket: int) -> int:
        """Files of several runs as those of one; how many there are. A file never gets longer than FILE_POSTINGS allows, but for one long content."""
        held, size, made = [], 0, 0
        for name in [n for run in runs for n in self.folder.names(f"{run}/{bucket}", SUFFIX)]:
            part = Run(self.folder, name).contents()
            n = int(np.diff(part["fps"].combine_chunks().offsets.to_numpy()).sum())
            if held and size + n > FILE_POSTINGS:
                write_run(self.folder, f"{into}/{bucket}/{made}", pa.concat_tables(held))
                held, size, made = [], 0, made + 1
            held.append(part)
            size += n
        if held:
            write_run(self.folder, f"{into}/{bucket}/{made}", pa.concat_tables(held))
            made += 1
        return made


class Lookup:
    """One task's view of a store: filters stay in memory while the task is in their bucket."""

    def __init__(self, store: Store):
        self.store, self.at, self.open = store, None, []

    def covering(self, blocks: np.ndarray, fps: np.ndarray, sizes: np.ndarray, least: float) -> Iterator[tuple[int, float, dict]]:
        """(asked content, coverage, stored content) over all runs of the contents' buckets."""
        if not self.store.runs or not len(sizes):
            return
        buckets, starts = self.store.bucket(blocks), np.cumsum(sizes) - sizes
        for b in np.unique(buckets).tolist():
            if b != self.at:
                self.at, self.open = b, [Run(self.store.folder, name) for name in self.store.files(b)]
            mine = np.flatnonzero(buckets == b)
            part, owner = fps[_ranges(starts[mine], sizes[mine])], np.repeat(np.arange(len(mine)), sizes[mine])
            for run in self.open:
                asked, coverage, stored = run.covering(part, owner, sizes[mine], least)
                for a, share, row in zip(mine[asked].tolist(), coverage.tolist(), stored.to_pylist(), strict=True):
                    yield a, share, row
