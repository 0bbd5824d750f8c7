"""URL filter over a sorted array of digests: 64-bit xxhash keys of (host, path) rules.

The array lies in one file: sorted keys, verdicts, where each rule's string ends, and the
strings. Spark ships the file to every executor; tasks map it into memory, so that it may be
larger than a worker's memory and is shared by all workers of a machine. A batch of URLs is
probed by vectorised binary search, once for each number of host labels and length of path
that some rule has; a hit counts only if the stored string is the one looked up.
"""

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rules a list may have; beyond it the driver, which sorts them, refuses the list.
MAX_RULES = 20_000_000
_PARTS = r"(?s)^.*?://(?P<host>[^/?#]*)(?P<path>[^?#]*)"
_VERDICTS = np.array(["block", "allow"])


def write_digests(rules: list[tuple[str, str, str]], path: str) -> list[tuple[int, int]]:
    """Write the file; what comes back are the (host labels, path length) pairs of the rules.

    ``rules`` are (verdict, host, path). Of rules with one host and path, a block wins.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; a list may have {MAX_RULES}")
    verdict = {}
    for name, host, start in rules:
        if name not in ("allow", "block"):
            raise ValueError(f"verdict {name!r}")
        text = (host.lower() + start).encode()
        verdict[text] = verdict.get(text, True) and name == "allow"
    ordered = sorted((xxhash.xxh64_intdigest(text), text) for text in verdict)
    with open(path, "wb") as file:
        np.array([len(ordered)], np.int64).tofile(file)
        np.array([key for key, _ in ordered], np.uint64).tofile(file)
        np.cumsum([0] + [len(text) for _, text in ordered], dtype=np.int64).tofile(file)
        np.array([verdict[text] for _, text in ordered], np.uint8).tofile(file)
        file.write(b"".join(text for _, text in ordered))
    return sorted({(host.count(".") + 1, len(start)) for _, host, start in rules})


class DigestArray:
    """The file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        self.count = int(data[:8].view(np.int64)[0])
        at = 8 + 8 * self.count
        self.keys, self.ends = data[8:at].view(np.uint64), data[at : at + 8 * self.count + 8].view(np.int64)
        at += 8 * self.count + 8
        self.allows, self.strings = data[at : at + self.count], data[at + self.count :]

    def find(self, texts: list[bytes]) -> np.ndarray:
        """Place of each text in the array, or -1."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, keys)
        found = np.full(len(texts), -1)
        for k in np.flatnonzero(self.keys[np.minimum(at, self.count - 1)] == keys if self.count else []):
            place = int(at[k])
            while place < self.count and self.keys[place] == keys[k]:  # rules whose digests collide
                if self.strings[self.ends[place] : self.ends[place + 1]].tobytes() == texts[k]:
                    found[k] = place
                    break
                place += 1
        return found


def _suffixes(hosts: pa.Array, labels: int) -> pa.Array:
    """The last labels of each host; null if it has fewer."""
    found = pc.extract_regex(hosts, rf"(?s)(?:^|\.)(?P<tail>[^.]*(?:\.[^.]*){{{labels - 1}}})$")
    return pc.struct_field(found, 0)


def judge(urls: pa.Array, rules: DigestArray, shapes: list[tuple[int, int]], default: str) -> list[pa.Array]:
    """Host, path, rule and verdict of each URL."""
    parts = pc.extract_regex(urls, _PARTS)
    host, path = (pc.fill_null(pc.struct_field(parts, k), "") for k in (0, 1))
    host = pc.ascii_lower(host)
    length = pc.utf8_length(path).to_numpy(zero_copy_only=False)
    best, place = np.zeros((2, len(urls)), np.int64), np.full(len(urls), -1)
    for labels, start in shapes:
        tail = _suffixes(host, labels)
        rows = np.flatnonzero(pc.is_valid(tail).to_numpy(zero_copy_only=False) & (length >= start))
        some = pa.array(rows)
        tails = tail.take(some)
        texts = pc.binary_join_element_wise(tails, pc.utf8_slice_codeunits(path.take(some), 0, start), "")
        found = rules.find([t.encode() for t in texts.to_pylist()])
        hosts = pc.utf8_length(tails).to_numpy(zero_copy_only=False).astype(np.int64)
        # The longest rule wins; of two as long, the one with the longer host.
        better = (found >= 0) & ((hosts + start > best[0, rows]) | ((hosts + start == best[0, rows]) & (hosts > best[1, rows])))
        chosen = rows[better]
        best[:, chosen], place[chosen] = (hosts[better] + start, hosts[better]), found[better]
    rule = [rules.strings[rules.ends[k] : rules.ends[k + 1]].tobytes().decode() if k >= 0 else None for k in place]
    verdict = [str(_VERDICTS[rules.allows[k]]) if k >= 0 else default for k in place]
    return [host, path, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]


def ship_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Sort the rules into a file of the driver, which Spark copies to the executors."""
    name = f"url-rules-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(), name)
    shapes = write_digests(rules, path)
    spark.sparkContext.addFile(path)
    return name, shapes


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` are (allow or block, host, start of the path). A rule fits its host and all
    subdomains; the longest that fits decides, else ``default``. A URL that is null or has no
    ``://`` has an empty host and path and fits no rule. Rows that repeat come out as
    often as they come; an empty table gives no rows, and without rules all get ``default``.
    """
    name, shapes = ship_rules(pages.sparkSession, rules)

    def look_up(batches):
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            columns = [batch.column(0), *judge(batch.column(1), array, shapes, default)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(look_up, f"page_id {kind}, host string, path string, rule string, verdict string")
