"""Secret scans with an incremental blob ledger.

Every version of every file is addressed by the SHA-256 of its content.  The ledger
holds one row for each (blob, rule, rule version) that was ever scanned, with its findings.
A scan takes the distinct blobs, leaves out every pair that the ledger has, scans the
rest once, appends the result, and joins the findings of the current rule versions
back to all paths.  Equal blobs are reduced on the map side before any text is shuffled,
so a content that a third of all paths share is one row a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import free_name, text_or_empty, written
from tessera.session import path_exists, scratch_path

Spans = list[tuple[int, int]]


@dataclass(frozen=True)
class Rule:
    """A named, versioned rule.  Raise ``version`` whenever ``find`` changes: only then are old blobs scanned again."""

    name: str
    version: int
    find: Callable[[str], Spans]


_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
#: The next line of any kind that frames a block, and what a block without its last line holds: headers and base64.
_PEM_NEXT = re.compile(r"-----(?:END (?:[A-Z]+ )*PRIVATE KEY-----|BEGIN )")
_PEM_BODY = re.compile(r"(?:[^\S\n]*\n[^\S\n]*(?:[A-Za-z][A-Za-z-]*: [^\n]*|[A-Za-z0-9+/=]+)?(?=\s|\Z))*")
_FORGE = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")


def _assign(text: str) -> Spans:
    return [m.span() for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]


def _access(text: str) -> Spans:
    return [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20] if "AKIA" in text else []


def _hex(text: str) -> Spans:
    return [m.span() for m in _HEX.finditer(text)]


def _pem(text: str) -> Spans:
    """Private keys up to their END line, encrypted ones with headers too; without one, up to where the block stops."""
    out, at = [], 0
    while "PRIVATE KEY" in text:
        begin = _PEM.search(text, at)
        if not begin:
            break
        framed = _PEM_NEXT.search(text, begin.end())
        whole = framed is not None and framed[0].startswith("-----END")
        at = framed.end() if whole else begin.end() + len(_PEM_BODY.match(text, begin.end(), framed.start() if framed else len(text))[0].rstrip())
        out.append((begin.start(), at))
    return out


def _plain(pattern: re.Pattern, mark: str) -> Callable[[str], Spans]:
    return lambda text: [m.span() for m in pattern.finditer(text)] if mark in text else []


#: The three base kinds, in their order.
BASE = (Rule("assign", 1, _assign), Rule("access", 1, _access), Rule("hex", 1, _hex))
RULES = (*BASE, Rule("pem", 2, _pem), Rule("forge", 1, _plain(_FORGE, "gh")), Rule("jwt", 1, _plain(_JWT, "eyJ")))
LEDGER = "blob binary, rule string, version int, spans string"


def blob_of(col: str = "text"):
    """Content address of a text (null counts as empty)."""
    return F.unhex(F.sha2(text_or_empty(col).cast("binary"), 256))


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, text, todo array<string>) -> ledger rows, one per blob and rule named in todo."""
    by_name = {r.name: r for r in rules}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for blob, text, todo in zip(batch["blob"], batch["text"], batch["todo"]):
                for name in todo:
                    rule = by_name[name]
                    out.append((blob, name, rule.version, ",".join(f"{a}:{b}" for a, b in rule.find(text))))
            yield pd.DataFrame(out, columns=["blob", "rule", "version", "spans"])

    return blobs.select("blob", "text", "todo").mapInPandas(scan, LEDGER)


def scan_versions(versions: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """(path columns..., text) -> (path columns..., blob, findings).

    ``findings`` maps a rule's name to its spans ("start:end", comma-joined; code points, end
    exclusive); rules that found nothing are not in it.  ``ledger`` is a folder of Parquet
    rows that this call reads, extends and leaves behind.  Null texts count as
    empty.  Repeated rows come back as often as they stand.
    """
    spark = versions.sparkSession
    blob = free_name([*versions.columns, "blob", "findings"], "blob__")
    paths = written(versions.withColumn(blob, blob_of()).drop("text"), "secret-paths")
    current = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]
    wanted = paths.select(F.col(blob).alias("blob")).distinct().select("blob", F.explode(F.array(*current)).alias("r")).select("blob", "r.*")
    if path_exists(spark, ledger):
        wanted = wanted.join(spark.read.schema(LEDGER).parquet(ledger).select("blob", "rule", "version").distinct(), ["blob", "rule", "version"], "left_anti")
    todo = wanted.groupBy("blob").agg(F.sort_array(F.collect_set("rule")).alias("todo"))  # at most one entry a rule
    texts = versions.select(blob_of().alias("blob"), text_or_empty().alias("text")).dropDuplicates(["blob"])
    scan_blobs(texts.join(todo, "blob"), rules).write.mode("append").parquet(ledger)

    known = spark.read.schema(LEDGER).parquet(ledger).filter(F.struct("rule", "version").isin(current) & (F.col("spans") != ""))
    found = known.groupBy("blob").agg(F.map_from_entries(F.collect_set(F.struct("rule", "spans"))).alias("findings"))
    other, findings = free_name([*versions.columns, blob], "found_blob__"), free_name(versions.columns, "findings__")
    found = found.withColumnRenamed("blob", other).withColumnRenamed("findings", findings)
    out = paths.join(found, F.col(blob) == F.col(other), "left")
    empty = F.create_map().cast("map<string,string>")
    kept = [F.col(f"`{c}`") for c in versions.columns if c != "text"]
    return out.select(*kept, F.col(blob).alias("blob"), F.coalesce(findings, empty).alias("findings"))


DIGEST = "struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string>"


def digest_column(findings, rules=RULES):
    """Counts and span lists of a findings map; base kinds by start, then rule order."""
    order = {r.name: k for k, r in enumerate(rules)}
    base = {r.name for r in BASE}

    @pandas_udf(DIGEST)
    def digest(lists: pd.Series) -> pd.DataFrame:
        rows = []
        for flat in lists:
            spans = []
            for entry in flat.split(";") if flat else ():
                name, _, at = entry.partition("=")
                spans += [(int(a), order[name], name, int(b)) for a, b in (x.split(":") for x in at.split(","))]
            spans.sort()
            join = lambda xs: ",".join(f"{n}:{a}:{b}" for a, _, n, b in xs)
            kinds = [s[2] for s in spans]
            rows.append((*(kinds.count(r.name) for r in BASE), hashlib.sha256(join([s for s in spans if s[2] in base]).encode()).hexdigest(), join(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return digest(F.array_join(F.transform(F.map_entries(findings), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


def scan_documents(docs: DataFrame, ledger: str | None = None, rules=RULES) -> DataFrame:
    """documents -> doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Every document is a path holding one blob.  Without ``ledger`` a new one is begun in
    the shared scratch folder.  A null text counts as empty; empty texts find nothing.  Null and repeated doc_ids are
    rows like any others; texts are scanned whole, whatever their length; other columns are ignored, whatever their
    names.  Empty input gives no rows.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "secret-ledger")
    found = scan_versions(docs.select("doc_id", "text"), ledger, rules)
    return found.select("doc_id", digest_column(F.col("findings"), rules).alias("d")).select("doc_id", "d.*")
