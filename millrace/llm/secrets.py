"""Secret scans over every version of every document, by an incremental ledger of scanned texts.

A text is addressed by the SHA-256 of its UTF-8 bytes (its blob), whichever paths and versions hold it.  The ledger
keeps, for each scan of a blob, the rules it was scanned with (`name@version`) and what they found.  A new delivery is
scanned in three steps:

1. every row gets its blob, and each blob one row that stands for it;
2. blobs meet the ledger: what is left are the rules that a blob has not been scanned with, and only these texts are
   read again and scanned, with only these rules;
3. the findings of the current rules are joined back from the ledger to all rows that hold the blob.

So a text that comes back under another path costs a digest, and a new rule or rule version rescans each blob once with
that rule alone.  Copies never share a task: a blob is scanned through its one row, and the join back splits blobs with
very many rows.  A scan that is repeated after a failure adds equal rows, which reading the ledger takes as one.

Spans are code points of the text, end exclusive.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import pieces, raw, settle
from millrace.plans.skew import salted_join
from millrace.plans.staging import fresh_dir, staged


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of `pattern` that do not overlap; those whose `group` is shorter than `least` are dropped.

    `hints` are lower-case byte strings; a text that has none of them in any case of A-Z cannot match.  `probe` is a
    byte pattern that every text with a match contains.
    """

    name: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    hints: tuple[bytes, ...] = ()
    probe: bytes = b""

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern).finditer(text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


def _either(word: str) -> str:
    """The word in either case of A-Z only; a flag would let other alphabets match."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The patterns of the three base kinds.
ASSIGN = (
    f"({'|'.join(map(_either, ('password', 'passwd', 'secret', 'token', 'api_?key')))})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Rule("assign", 1, ASSIGN, 12, 2, (b"passw", b"secret", b"token", b"apikey", b"api_key")),
    Rule("access", 1, "AKIA[A-Z0-9]+", 18, 0, (b"akia",)),
    # The whole runs of at least 16 are the matches of the run of any length that are long enough.
    Rule("hex", 1, "[0-9a-f]{16,}", 16, 0, (), b"[0-9a-f]{16}"),
)
# Published shapes of further secrets.
EXTRA = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, (b"private key-----",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, (b"eyj",)),
    Rule("code_host", 1, "gh[oprsu]_[A-Za-z0-9]{36,}", 0, 0, (b"gho_", b"ghp_", b"ghr_", b"ghs_", b"ghu_")),
)
RULES = BASE + EXTRA

SPAN = "struct<kind:string,start:long,end:long>"
LEDGER = f"blob binary, rules array<string>, found array<{SPAN}>"


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class ScanLedger:
    """One row per scan of a blob: `blob`, the `rules` it was scanned with, and all spans they `found`."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or fresh_dir(spark, "scans")

    def read(self) -> DataFrame:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], LEDGER)
        rows = self.spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(self.path)
        # A scan repeated after a failure left equal rows.
        return rows.dropDuplicates(["blob", "rules"])

    def append(self, scans: DataFrame) -> None:
        scans.write.parquet(f"{self.path}/scan-{uuid.uuid4().hex}")

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """`blobs` with the `rules` each one has not been scanned with; blobs with none left out go."""
        wanted = F.array(*[F.lit(r.key) for r in rules])
        seen = self.read().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
        rows = blobs.join(seen, "blob", "left")
        left = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
        return rows.withColumn("rules", left).drop("_seen").where(F.size("rules") > 0)

    def findings(self, rules: tuple[Rule, ...]) -> DataFrame:
        """`blob` and the spans `found` by the current rules, for blobs that have any."""
        current = F.array(*[F.lit(r.key) for r in rules])
        rows = self.read().where(F.size("found") > 0)
        kept = F.filter("rules", lambda r: F.array_contains(current, r))
        names = F.transform(kept, lambda r: F.substring_index(r, "@", 1))
        rows = rows.select("blob", F.explode(F.filter("found", lambda s: F.array_contains(names, s["kind"]))).alias("span"))
        # A text's own findings, so no group here is larger than one text.
        return rows.groupBy("blob").agg(F.collect_set("span").alias("found"))


def scan_texts(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Scan rows of blob, text and the rules to use."""

    def run(batches):
        by_key = {rule.key: rule for rule in rules}
        probes = {rule.key: re.compile(rule.probe) for rule in rules if rule.probe}
        for batch in pieces(batches):
            wanted, found = batch.column("rules").to_pylist(), []
            for keys, data in zip(wanted, raw(batch.column("text")), strict=True):
                data = data or b""
                low, text, spans = data.lower(), None, []
                for key in keys:
                    rule = by_key[key]
                    if rule.hints and not any(hint in low for hint in rule.hints):
                        continue
                    if key in probes and not probes[key].search(data):
                        continue
                    text = data.decode(errors="replace") if text is None else text
                    spans += [{"kind": rule.name, "start": a, "end": b} for a, b in rule.spans(text)]
                found.append(spans)
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("rules"), pa.array(found, pa.list_(span))], names=["blob", "rules", "found"]
            )

    return texts.select("blob", "rules", "text").mapInArrow(run, LEDGER)


def scan_versions(
    versions: DataFrame, keys: list[str], ledger: ScanLedger, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """`keys` (path, version and the like), `blob` and the `spans` of every row: kind, start, end, by start, then in the
    order of `rules`.

    Null texts are empty, empty texts have no spans.  Keys may be null or repeat; every row gives one row.  Other
    columns are left alone, and very long texts are scanned whole.
    """
    settle(versions.sparkSession)
    rows = versions.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("text"))
    at = [f"k{i}" for i in range(len(keys))]
    rows = rows.withColumn("blob", blob(F.col("text")))
    addressed = staged(rows.select(*at, "blob"), "addressed")

    # One row stands for a blob: its least keys, nulls first.
    first = addressed.groupBy("blob").agg(F.min(F.struct(*at)).alias("_first"))
    unseen = ledger.unseen(first, rules).select(F.struct("blob", "_first").alias("_place"), "rules")
    texts = rows.select(F.struct("blob", F.struct(*at).alias("_first")).alias("_place"), "text")
    # Equal rows scan twice here and are one row of the ledger.
    texts = texts.join(unseen, "_place").select("_place.blob", "rules", "text")
    ledger.append(scan_texts(texts, rules))

    order = {rule.name: i for i, rule in enumerate(rules)}
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    ranked = F.transform("found", lambda s: F.struct(s["start"].alias("start"), places[s["kind"]].alias("at"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    found = staged(ledger.findings(rules).select("blob", spans.alias("spans")), "spans")
    out = salted_join(addressed, found, ["blob"], "left", left_by=at)
    named = [F.col(a).alias(k) for a, k in zip(at, keys, strict=True)]
    return out.select(*named, "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def document_secrets(docs: DataFrame, ledger: ScanLedger | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of `docs`."""
    ledger = ledger or ScanLedger(docs.sparkSession)
    rows = scan_versions(docs, ["doc_id"], ledger)
    names = [rule.name for rule in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.col("spans.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{n}") for n in names]
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_kind(at: int, rule: Rule, pattern: str) -> str:
    """Matches of one rule by marking them in the text and adding up the lengths of what lies before each."""
    quoted = pattern.replace("'", "''")
    long_enough = f"length(regexp_extract(parts[k], '{quoted}', {rule.group})) >= {rule.least}" if rule.group else f"length(parts[k]) >= {rule.least}"
    return f"""select doc_id, '{rule.name}' as kind, {at} as place, parts[k] as m,
    cast(coalesce(list_sum(list_transform(parts[1:k - 1], lambda p: length(p))), 0) as bigint) as s from (
        select doc_id, parts, unnest(range(2, len(parts) + 1, 2)) as k from (
            select doc_id, string_split(regexp_replace(t, '{quoted}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) as parts from d))
    where {long_enough}"""


# The kinds as given, hexadecimal runs of any length included.
_SQL = [_sql_kind(i, rule, "[0-9a-f]+" if rule.name == "hex" else rule.pattern) for i, rule in enumerate(RULES)]
_BASE_KINDS = ", ".join(f"'{rule.name}'" for rule in BASE)
ORACLE = f"""with d as (select doc_id, translate(coalesce(text, ''), chr(1), chr(2)) as t from documents),
found as ({' union all '.join(_SQL)}),
named as (select doc_id, kind, place, s, kind || ':' || s || ':' || (s + length(m)) as span from found),
per as (select doc_id, {', '.join(f"count(*) filter (kind = '{rule.name}') as n_{rule.name}" for rule in BASE)},
    string_agg(span, ',' order by s, place) filter (kind in ({_BASE_KINDS})) as base,
    string_agg(span, ',' order by s, place) as spans from named group by doc_id)
select doc_id, {', '.join(f"coalesce(n_{rule.name}, 0) as n_{rule.name}" for rule in BASE)},
sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join per using (doc_id)"""
