"""Saved results that know what they are: a manifest with kind, settings and digest next to the data, checked when they are read.

A table keeps its own Parquet files; vocabularies and models are a handful of named arrays, whose size their parameters bound.
A wrong kind, a changed or missing file, or another version of the form is an error, not another result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.kernel import KernelMap
from corpusloom.operators.classify import SvmModel
from corpusloom.operators.features import Vocabulary
from corpusloom.operators.many_mixtures import Mixture
from corpusloom.operators.many_topics import Spec, TopicModel
from corpusloom.operators.storage import load_artifact, save_artifact

FORM = 1
MANIFEST = "kind string, form int, settings string, schema string, digest string"
PARTS = "name string, place int, kind string, shape array<long>, data binary"


class ArtifactError(ValueError):
    """What lies at a path is not what it should be."""


def table_digest(df: DataFrame) -> str:
    """Number of rows and sum of their hashes, whatever their order. Vectors count by their places and values."""
    vectors = {f.name for f in df.schema.fields if f.dataType.typeName() == "vectorudt"}
    each = F.xxhash64(*[F.to_json(F.struct(F.unwrap_udt(c).alias("v") if c in vectors else F.col(f"`{c}`").alias("v"))) for c in df.columns])
    n, total = df.select(each.cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    return f"{n}:{total}"


def _write_manifest(spark: SparkSession, path: str, kind: str, settings: dict, schema: str, digest: str) -> None:
    row = (kind, FORM, json.dumps(settings, sort_keys=True), schema, digest)
    save_artifact(spark.createDataFrame([row], MANIFEST).coalesce(1), f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str, kind: str | None = None) -> dict:
    found = load_artifact(spark, f"{path}/manifest").first()
    if found is None or found.form != FORM:
        raise ArtifactError(f"{path} has no manifest of form {FORM}")
    if kind is not None and found.kind != kind:
        raise ArtifactError(f"{path} holds {found.kind}, not {kind}")
    return {**found.asDict(), "settings": json.loads(found.settings)}


def save_table(df: DataFrame, path: str, kind: str = "table", settings: dict | None = None) -> DataFrame:
    """Rows with a manifest. The digest is taken of what was written."""
    written = save_artifact(df, f"{path}/data")
    _write_manifest(df.sparkSession, path, kind, settings or {}, written.schema.json(), table_digest(written))
    return written


def load_table(spark: SparkSession, path: str, kind: str = "table", verify: bool = True) -> DataFrame:
    manifest = read_manifest(spark, path, kind)
    rows = load_artifact(spark, f"{path}/data")
    if json.loads(rows.schema.json()) != json.loads(manifest["schema"]):
        raise ArtifactError(f"{path} has columns other than those written")
    if verify and table_digest(rows) != manifest["digest"]:
        raise ArtifactError(f"{path} has rows other than those written")
    return rows


Parts = dict[str, np.ndarray]


def _parts_digest(parts: Parts) -> str:
    digest = hashlib.sha256()
    for name, array in sorted(parts.items()):
        digest.update(f"{name}:{array.dtype.str}:{array.shape}:".encode())
        digest.update(np.ascontiguousarray(array).tobytes())
    return digest.hexdigest()


def _texts(words: list[str]) -> np.ndarray:
    return np.frombuffer("\x00".join(words).encode(), np.uint8)


def _words(data: np.ndarray, n: int) -> list[str]:
    return data.tobytes().decode().split("\x00") if n else []


@dataclass(frozen=True)
class Form:
    """How a kind of object becomes settings and arrays, and back."""

    kind: str
    of: type
    take: Callable[[object], tuple[dict, Parts]]
    build: Callable[[dict, Parts], object]


def _take_map(m: KernelMap | None) -> tuple[dict, Parts]:
    return ({}, {}) if m is None else ({"map": m.settings()}, m.arrays())


FORMS = [
    Form(
        "vocabulary", Vocabulary,
        lambda v: ({"n_docs": v.n_docs, "n": len(v.terms)}, {"terms": _texts(v.terms), "tf": np.array(v.tf, np.int64), "df": np.array(v.df, np.int64)}),
        lambda s, p: Vocabulary(_words(p["terms"], s["n"]), p["tf"].tolist(), p["df"].tolist(), s["n_docs"]),
    ),
    Form(
        "svm", SvmModel,
        lambda m: ({"kernel": m.kernel, "C": m.C, "gamma": m.gamma, "dim": m.dim, **_take_map(m.map)[0]}, {"weights": m.weights, **_take_map(m.map)[1]}),
        lambda s, p: SvmModel(p["weights"], s["kernel"], s["C"], s["gamma"], s["dim"], KernelMap.restore(s["map"], p) if "map" in s else None),
    ),
    Form(
        "topics", TopicModel,
        lambda m: ({"k": m.spec.k, "decay": m.spec.decay}, {"counts": m.counts}),
        lambda s, p: TopicModel(Spec(s["k"], s["decay"]), p["counts"]),
    ),
    Form(
        "mixture", Mixture,
        lambda m: ({"log_likelihood": m.log_likelihood, "rows": m.rows}, {"weights": m.weights, "means": m.means, "diagonals": m.diagonals, "loadings": m.loadings}),
        lambda s, p: Mixture(p["weights"], p["means"], p["diagonals"], p["loadings"], s["log_likelihood"], s["rows"]),
    ),
]


def _form_of(thing: object) -> Form:
    form = next((f for f in FORMS if isinstance(thing, f.of)), None)
    if form is None:
        raise ArtifactError(f"no form for {type(thing).__name__}")
    return form


def same_object(a: object, b: object) -> bool:
    """Whether two objects have the same settings and arrays."""
    (one, left), (two, right) = _form_of(a).take(a), _form_of(b).take(b)
    return type(a) is type(b) and one == two and _parts_digest(left) == _parts_digest(right)


CELL = 1 << 24  # bytes of an array per row


def save_object(spark: SparkSession, thing: object, path: str) -> None:
    """A vocabulary, SVM, topic model or mixture."""
    form = _form_of(thing)
    settings, parts = form.take(thing)
    rows = []
    for name, array in parts.items():
        data = np.ascontiguousarray(array).tobytes()
        for i in range(max(1, -(-len(data) // CELL))):
            rows.append((name, i, array.dtype.str, list(array.shape), bytearray(data[i * CELL : (i + 1) * CELL])))
    written = save_artifact(spark.createDataFrame(rows, PARTS).coalesce(1), f"{path}/data")
    _write_manifest(spark, path, form.kind, settings, written.schema.json(), _parts_digest(parts))


def load_object(spark: SparkSession, path: str, kind: str | None = None) -> object:
    """What save_object wrote; with `kind`, only if it is that."""
    manifest = read_manifest(spark, path, kind)
    form = next((f for f in FORMS if f.kind == manifest["kind"]), None)
    if form is None:
        raise ArtifactError(f"{path} holds {manifest['kind']}, which is a table or unknown")
    cells: dict[str, list] = {}
    for r in sorted(load_artifact(spark, f"{path}/data").collect(), key=lambda r: (r.name, r.place)):
        cells.setdefault(r.name, []).append(r)
    parts = {name: np.frombuffer(b"".join(bytes(r.data) for r in own), own[0].kind).reshape(own[0].shape).copy() for name, own in cells.items()}
    if _parts_digest(parts) != manifest["digest"]:
        raise ArtifactError(f"{path} has data other than those written")
    return form.build(manifest["settings"], parts)
