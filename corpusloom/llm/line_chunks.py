"""Line dedup by content-defined chunks of lines.

A line is hashed, and a rolling hash over the hashes of a line and the one before it says whether a chunk ends there.
So a border depends on two lines only, and text put in or taken out elsewhere does not shift it. Chunks of several
lines with words that occur more than once among all documents are compared byte for byte; the first one, by document
and place, stays, and the others are removed.

A border takes effect only once its chunk holds two lines with a word, as a single line is never removed; every second
line may be one. What is left at the end of a text is compared along with the chunk before it; a chunk never equals such a
pair, as its start alone says where it ends. Lines of a passage before its first border and after its last one share chunks
with other text and stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.storage import settle

WORD = re.compile(r"[^\x20\x09-\x0D]")
WINDOW_LINES, FACTOR, DIVISOR = 2, 31, 2
LEAST_LINES = 2  # with a word
SALTS = 16


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.md5(line.encode(), usedforsecurity=False).digest()[:4], "big")


def chunk_ends(lines: list[str]) -> list[int]:
    """Where the rolling hash sets a border: the number of the line after it, and the end."""
    rolling, recent, ends = 0, [0] * WINDOW_LINES, []
    for i, line in enumerate(lines):
        new = line_hash(line)
        rolling = (rolling - recent.pop(0) * FACTOR ** (WINDOW_LINES - 1)) * FACTOR + new
        recent.append(new)
        if rolling % DIVISOR == 0:
            ends.append(i + 1)
    return ends if ends and ends[-1] == len(lines) else [*ends, len(lines)]


def n_worded(lines: list[str]) -> int:
    return sum(WORD.search(line) is not None for line in lines)


def joined_ends(lines: list[str], ends: list[int], least: int) -> list[int]:
    """The ends behind `least` lines with a word since the one before, and the end of the text."""
    out, at, n = [], 0, 0
    for end in ends:
        n += n_worded(lines[at:end])
        at = end
        if n >= least or end == len(lines):
            out.append(end)
            n = 0
    return out


def chunks(text: str, least: int = LEAST_LINES) -> list[list[str]]:
    lines = text.split("\n")
    ends = joined_ends(lines, chunk_ends(lines), least)
    return [lines[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def compared(cut: list[list[str]], at: int, least: int = LEAST_LINES) -> list[str]:
    """The lines that stand for a chunk: its own, and those of the chunk before a short last one."""
    return cut[at - 1] + cut[at] if 0 < at == len(cut) - 1 and n_worded(cut[at]) < least else cut[at]


def comparable(chunk: list[str]) -> bool:
    return len(chunk) >= LEAST_LINES and n_worded(chunk) >= LEAST_LINES


def _field(docs: DataFrame, name: str, like: str) -> T.StructField:
    return T.StructField(name, docs.schema[like].dataType)


def _chunk_rows(docs: DataFrame, least: int) -> DataFrame:
    """(id, digest, chunk, hash) of every chunk that could be removed."""
    schema = T.StructType([_field(docs, "id", "id"), *T._parse_datatype_string("digest long, chunk int, hash binary").fields])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at, number, hashes = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                cut = chunks(text or "", least)
                for k in range(len(cut)):
                    if comparable(chunk := compared(cut, k, least)):
                        at.append(i)
                        number.append(k)
                        hashes.append(hashlib.md5("\n".join(chunk).encode(), usedforsecurity=False).digest())
            at = pa.array(at, pa.int64())
            columns = [batch.column("id").take(at), batch.column("digest").take(at), pa.array(number, pa.int32()), pa.array(hashes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def _chunk_texts(docs: DataFrame, least: int) -> DataFrame:
    """(id, digest, chunk, lines) of the chunks named in each row."""
    schema = T.StructType([_field(docs, "id", "id"), *T._parse_datatype_string("digest long, chunk int, lines string").fields])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at, number, lines = [], [], []
            for i, (text, wanted) in enumerate(zip(batch.column("text").to_pylist(), batch.column("chunks").to_pylist(), strict=True)):
                cut = chunks(text or "", least)
                for k in wanted:
                    at.append(i)
                    number.append(k)
                    lines.append("\n".join(compared(cut, k, least)))
            at = pa.array(at, pa.int64())
            columns = [batch.column("id").take(at), batch.column("digest").take(at), pa.array(number, pa.int32()), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def _by_document(places: DataFrame) -> DataFrame:
    """A document has a bounded number of chunks, so its list fits a row."""
    grouped = places.groupBy("id", "digest").agg(F.sort_array(F.collect_set("chunk")).alias("chunks"))
    return grouped.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "chunks")


_SAME = lambda: F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))


def repeated_chunks(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: int = LEAST_LINES) -> DataFrame:
    """(_id, _digest, chunks): numbers of the chunks to remove, by document id and hash of its text."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    rows = settle(_chunk_rows(texts, least))
    repeated = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    # a chunk may stand in a third of all documents: its hash is salted
    every = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "digest", "chunk"), F.lit(SALTS)))
    places = settle(salted.join(every, ["hash", "salt"], "left_semi").select("id", "digest", "chunk").distinct())
    found = _chunk_texts(texts.join(_by_document(places), _SAME()).select("id", "digest", "text", "chunks"), least)
    firsts = found.groupBy("lines").agg(F.min(F.struct("id", "digest", "chunk")).alias("first")).select("first.*")
    firsts = firsts.select(*[F.col(c).alias(f"f_{c}") for c in firsts.columns])
    same = F.col("id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest")) & (F.col("chunk") == F.col("f_chunk"))
    return settle(_by_document(places.join(firsts, same, "left_anti")))


def dedup_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: int = LEAST_LINES) -> DataFrame:
    """Replaces every text by what is left of it, and adds n_lines and n_removed_lines.

    Rows that agree in id and text are one document and get one result. A null text stays null and has 0 lines; an empty
    one has one empty line. A document whose lines are all removed keeps an empty text. A text with fewer than two lines
    with a word is never shortened. Further columns stay; those named like a new one are replaced.
    """
    removed = repeated_chunks(docs, text, id_col, least)
    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_removed_lines")]
    fields = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in kept]
    schema = T.StructType([*fields, *T._parse_datatype_string("n_lines long, n_removed_lines long").fields])
    names = [f"c{i}" for i in range(len(kept))]
    id_at, text_at = ([f.name for f in kept].index(c) for c in (id_col, text))
    plain = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names, strict=True)])
    keyed = plain.withColumns({"id": F.col(names[id_at]), "digest": F.xxhash64(names[text_at])})
    joined = keyed.join(removed, _SAME(), "left").select(*names, "chunks")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out, totals, gone = [], [], []
            for body, drop in zip(batch.column(text_at).to_pylist(), batch.column("chunks").to_pylist(), strict=True):
                drop = set(drop or ())
                cut = chunks(body, least) if drop else []
                lost = sum(len(c) for k, c in enumerate(cut) if k in drop)
                gone.append(lost)
                totals.append(0 if body is None else body.count("\n") + 1)
                out.append("\n".join(line for k, c in enumerate(cut) if k not in drop for line in c) if drop else body)
            columns = [batch.column(i) for i in range(len(kept))]
            columns[text_at] = pa.array(out, columns[text_at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], schema.names)

    return joined.mapInArrow(run, schema)


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line, CAST('0x' || substr(md5(ls[i]), 1, 8) AS BIGINT) AS h
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
e AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded, CASE WHEN (coalesce(lag(h) OVER w, 0) * 31 + h) % 2 = 0 THEN 1 ELSE 0 END AS ends
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM e),
w AS (SELECT doc_id, part, count(*) FILTER (worded) AS n FROM c GROUP BY doc_id, part),
j AS (SELECT doc_id, list_reduce(list({'n': n, 'g': 0::BIGINT, 'every': [0::BIGINT]} ORDER BY part), lambda a, b: {
    'n': CASE WHEN a.n >= 2 THEN b.n ELSE a.n + b.n END, 'g': a.g + CASE WHEN a.n >= 2 THEN 1 ELSE 0 END,
    'every': list_append(a.every, a.g + CASE WHEN a.n >= 2 THEN 1 ELSE 0 END)}).every AS gs FROM w GROUP BY doc_id),
m AS (SELECT doc_id, unnest(gs) AS chunk, generate_subscripts(gs, 1) - 1 AS part FROM j),
x AS (SELECT c.doc_id, i, line, worded, chunk FROM c JOIN m USING (doc_id, part)),
k AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS own, count(*) FILTER (worded) AS n FROM x GROUP BY doc_id, chunk),
p AS (SELECT doc_id, chunk, n < 2 AND lag(own) OVER w IS NOT NULL AS short, own, n, lag(own) OVER w AS before, lag(n) OVER w AS n_before
  FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY chunk)),
b AS (SELECT doc_id, chunk, CASE WHEN short THEN before || chr(10) || own ELSE own END AS body, CASE WHEN short THEN n + n_before ELSE n END AS n FROM p),
r AS (SELECT doc_id, chunk, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) AS nth FROM b WHERE n >= 2),
g AS (SELECT x.doc_id, i, line, coalesce(nth, 1) > 1 AS gone FROM x LEFT JOIN r USING (doc_id, chunk))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed_lines,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
FROM g GROUP BY doc_id
"""
