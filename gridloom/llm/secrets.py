"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content. The ledger holds the (blob, rule version) pairs already scanned with
their findings; a run scans each unseen pair once and joins findings back to all rows that hold the blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Change it whenever a rule changes: blobs are then scanned again.
RULES = "base-1"
KINDS = ("assign", "access", "hex")
# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CUES = ("passw", "secret", "token", "api")
FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by start, then kind as listed. Runs with a minimum length equal longer runs filtered."""
    low = text.lower()
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if any(c in low for c in CUES) else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(out)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py() or "")] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["blob", "findings"])


def blobs(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, blob): the content address of each row's text, null being empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("blob"))


def scan_new(docs: DataFrame, ledger: DataFrame | None = None, rules: str = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(blob, rules, findings) of the blobs that ``ledger`` (same columns) lacks under ``rules``: append it to the ledger.

    Blobs without findings are recorded too, with an empty list. One row per blob is chosen on addresses alone, so a hot
    text costs a partial ``min``; then only the chosen rows' texts move to be scanned.
    """
    small_batches(docs.sparkSession)
    first = cut(blobs(docs, text, id_col)).groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    if ledger is not None:
        first = first.join(ledger.where(F.col("rules") == rules).select("blob"), "blob", "left_anti")
    value = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(id_col).alias("_id"), value.alias("_text"), F.unhex(F.sha2(value.cast("binary"), 256)).alias("_blob"))
    # The addresses are the small side and are hashed, so the texts are exchanged but never sorted.
    unseen = texts.join(first.hint("shuffle_hash"), F.expr("_id <=> doc_id AND _blob = blob"), "left_semi")
    found = unseen.select("_blob", "_text").mapInArrow(_scan, f"blob binary, findings {FINDINGS}")
    return found.dropDuplicates(["blob"]).select("blob", F.lit(rules).alias("rules"), "findings")


def findings(docs: DataFrame, ledger: DataFrame, rules: str = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, blob, findings) for every row whose blob the ledger has under ``rules``; only hits are joined by blob."""
    hits = ledger.where((F.col("rules") == rules) & (F.size("findings") > 0)).select("blob", "findings")
    none = F.array().cast(FINDINGS)
    return blobs(docs, text, id_col).join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, spans as text and their SHA-256, a row per row of :func:`findings`.

    Null or empty text: no spans, and the digest of the empty string. Repeated rows each have their row; no rows, no rows.
    """
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    spans = F.array_join(F.transform("findings", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    out = found.withColumn("spans", spans)
    return out.select("doc_id", *(count(k) for k in KINDS), F.sha2("spans", 256).alias("base_sha256"), "spans")


def brute(text: str | None) -> tuple[int, int, int, str, str]:
    """What :func:`digest` gives for one text, by the patterns as stated; for tests."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))
    return (*(sum(k == i for _, k, _ in out) for i in range(3)), hashlib.sha256(spans.encode()).hexdigest(), spans)
