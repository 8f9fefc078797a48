"""Language identification by Bayesian evidence fusion.

The log posterior of a document's language adds up

* the text: trigrams of letters under per-language models, trained here from
  the declared languages of a bounded, documented sample of rows (a trigram's
  share of the evidence is damped, as neighbours overlap);
* the declared language (markup or metadata), right with probability ``TRUST``;
* the host: a prior that is smoothed towards its address suffix, which is
  smoothed towards the whole corpus. The counts are sums of text and markup
  posteriors per host, by grouped aggregation over all rows (a hot host is
  pre-aggregated); a document's own share is taken out of its host's counts.

A class ``und`` (letters without a language: every trigram alike) competes
with the languages. A document is rejected if it has no letters or ``und``
wins. Texts are read once, in whole, and never shuffled.

Defined cases: null and empty texts, and texts without letters, are ``und``
with confidence 1 and rejected; declared languages are taken by their primary
subtag (en, EN, en-US and en_US are one), and every one that occurs is a class;
a null, blank, ``und`` or unknown declared language is no evidence; null hosts form one host; repeated rows are judged each; without any
labelled row every document with letters is ``und``; no rows give no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, textnp

BUCKETS = 1 << 15
#: Labelled rows that the text models are trained on, for each language.
SAMPLE_ROWS = 2000
#: Languages whose counts are gathered at once in training.
LANGUAGE_BLOCK = 50
DAMP = 0.3
TRUST = 0.9
UNDEFINED = "und"
UNDEFINED_PRIOR = 1e-4
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 100.0
SLICE = 1 << 20
#: Documents times classes that are judged at once.
CELLS = 1 << 22

_LETTERS = textnp._LOWER.copy()
_LETTERS[[b for b in range(128) if not 97 <= _LETTERS[b] <= 122]] = 32


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of each text (those with a letter in the middle) and
    the index of their text."""
    data, offsets = textnp.flat(column)
    data = _LETTERS[data]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    middle = data[1:-1] != 32
    middle[(offsets[1:-1] - 1)[(offsets[1:-1] >= 1) & (offsets[1:-1] <= len(middle))]] = False
    middle[(offsets[1:-1] - 2)[(offsets[1:-1] >= 2) & (offsets[1:-1] <= len(data) - 1)]] = False
    at = np.flatnonzero(middle)
    wide = data.astype(np.uint32)
    gram = (wide[at] << np.uint32(16)) | (wide[at + 1] << np.uint32(8)) | wide[at + 2]
    gram = (gram * np.uint32(0x9E3779B1)) >> np.uint32(17)
    return gram.astype(np.int64), np.searchsorted(offsets, at + 1, "right") - 1


def tag(declared: Column) -> Column:
    """Lower-cased primary subtag of a declared language (private and
    grandfathered tags, x-... and i-..., whole); null if there is none."""
    whole = F.lower(F.trim(F.translate(declared.cast("string"), "_\t\n\r", "-   ")))
    first = F.when(whole.rlike("^[xi]-"), whole).otherwise(F.trim(F.substring_index(whole, "-", 1)))
    return F.when(~first.isin("", UNDEFINED), first)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, block: int = LANGUAGE_BLOCK) -> dict[str, np.ndarray]:
    """Log probabilities of trigram buckets for every declared language, by its
    primary subtag."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), tag(F.col(lang_col)).alias("lang")).where("lang IS NOT NULL")
    found = rows.groupBy("lang").count().orderBy("lang").collect()
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for piece in common.slices(batches, "text", SLICE):
            gram, text = trigrams(piece.column("text"))
            langs = np.array(piece.column("lang").to_pylist(), object)
            for lang in set(langs):
                n = np.bincount(gram[langs[text] == lang], minlength=BUCKETS)
                total[lang] = total.get(lang, 0) + n
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                             ["lang", "gram", "n"])

    out = {}
    for start in range(0, len(found), block):
        own = found[start:start + block]
        rate = F.create_map(*[F.lit(x) for r in own for x in (r.lang, 1e6 * min(1, sample_rows / r["count"]))])
        chosen = rows.where(draw < F.element_at(rate, F.col("lang"))).select("text", "lang")
        summed = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        total = {r.lang: np.full(BUCKETS, 0.5) for r in own}
        for r in summed.toLocalIterator():  # at most block x BUCKETS rows
            total[r.lang][r.gram] += r.n
        out |= {lang: np.log(n / n.sum()) for lang, n in total.items()}
    return dict(sorted(out.items()))


def suffix_of(host: Column) -> Column:
    """The last label of a host with a dot in it, else null."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1))


def declared_evidence(declared: list, names: list[str], trust: float) -> np.ndarray:
    """Log probability of each declared language under each class."""
    known = len(names) - 1
    at = {name: j for j, name in enumerate(names[:-1])}
    out = np.zeros((len(declared), len(names)))
    for row, d in zip(out, declared, strict=True):
        if d in at:
            row[:] = np.log((1 - trust) / max(1, known - 1))
            row[at[d]], row[-1] = np.log(trust), -np.log(known)
    return out


def identify(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             declared_col: str | None = "lang", host_col: str | None = "source", damp: float = DAMP, trust: float = TRUST,
             host_weight: float = HOST_WEIGHT, suffix_weight: float = SUFFIX_WEIGHT) -> DataFrame:
    """One row per document: id, text_key (hash of the text), declared,
    language, confidence, rejected."""
    names = [*model, UNDEFINED]
    sent = docs.sparkSession.sparkContext.broadcast(np.stack([*model.values(), np.full(BUCKETS, -np.log(BUCKETS))]))
    none = F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"),
        (F.col(declared_col).cast("string") if declared_col else none).alias("declared"),
        (tag(F.col(declared_col)) if declared_col else none).alias("tag"),
        (F.col(host_col).cast("string") if host_col else none).alias("host"))
    width = len(names)
    prior = np.zeros(width)
    if model:
        prior[-1] = np.log(UNDEFINED_PRIOR)

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), pa.array(values.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        step = max(1, CELLS // width)
        for piece in (part.slice(i, step) for part in common.slices(batches, "text", SLICE) for i in range(0, part.num_rows, step)):
            gram, text = trigrams(piece.column("text"))
            m = piece.num_rows
            edge = np.searchsorted(text, np.arange(m + 1))
            evidence = declared_evidence(piece.column("tag").to_pylist(), names, trust) + prior
            for j in range(width):
                upto = np.concatenate([[0.0], np.cumsum(table[j, gram])])
                evidence[:, j] += damp * (upto[edge[1:]] - upto[edge[:-1]])
            weight = np.exp(evidence - evidence.max(1, keepdims=True))
            weight *= (np.diff(edge) > 0)[:, None] / weight.sum(1, keepdims=True)
            kept = [c for c in piece.schema.names if c not in ("text", "tag")]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in kept], pa.array(np.diff(edge), pa.int64()), lists(evidence), lists(weight)],
                                             [*kept, "n", "evidence", "share"])

    kind = dict(rows.dtypes)["id"]
    seen = common.store(rows.mapInArrow(
        run, f"id {kind}, text_key long, declared string, host string, n long, evidence array<double>, share array<double>"), "language-evidence")
    seen = seen.withColumn("suffix", suffix_of(F.col("host")))

    k = range(width)
    hosts = common.store(seen.groupBy("host", "suffix").agg(*[F.sum(F.col("share")[i]).alias(f"h{i}") for i in k]), "language-hosts")
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(f"h{i}").alias(f"s{i}") for i in k])
    everything = hosts.agg(*[F.coalesce(F.sum(f"h{i}"), F.lit(0.0)) for i in k]).first()
    total = sum(everything)
    whole = [(x + 1) / (total + width) for x in everything]
    known = hosts.join(suffixes, hosts.suffix.eqNullSafe(suffixes.suffix))
    total_of = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    known = known.withColumn("in_suffix", total_of(F.array(*[f"s{i}" for i in k])))
    in_suffix = F.col("in_suffix")
    known = known.select(hosts.host.alias("of"), F.array(*[f"h{i}" for i in k]).alias("host_share"),
                         F.array(*[(F.col(f"s{i}") + suffix_weight * whole[i]) / (in_suffix + suffix_weight) for i in k]).alias("smooth"))
    known = common.hinted(common.store(known, "language-priors"), 100_000)
    fused = seen.join(known, seen.host.eqNullSafe(known.of)).withColumn(
        "others", F.zip_with("host_share", "share", lambda h, p: F.greatest(h - p, F.lit(0.0))))
    fused = fused.withColumn("rest", total_of(F.col("others")))
    fused = fused.withColumn("host_prior", F.zip_with("others", "smooth", lambda o, p: F.log((o + host_weight * p) / (F.col("rest") + host_weight))))
    fused = fused.withColumn("post", F.zip_with("evidence", "host_prior", lambda e, p: e + p))
    fused = fused.withColumn("best", F.array_max("post"))
    language = F.element_at(F.array(*map(F.lit, names)), F.array_position("post", F.col("best")).cast("int"))
    confidence = 1 / total_of(F.transform("post", lambda x: F.exp(x - F.col("best"))))
    empty = F.col("n") == 0
    fused = fused.select("id", "text_key", "declared", F.when(empty, UNDEFINED).otherwise(language).alias("language"),
                         F.when(empty, 1.0).otherwise(confidence).alias("confidence"))
    return fused.select(F.col("id").alias(id_col), "text_key", "declared", "language", "confidence", (F.col("language") == UNDEFINED).alias("rejected"))


def accepted(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that were not rejected."""
    gone = common.store(judged.where("rejected").select(F.col(id_col).alias("gone_id"), F.col("text_key").alias("gone_text")).distinct(), "language-rejected")
    gone = common.hinted(gone)
    return docs.join(gone, F.col(id_col).eqNullSafe(gone.gone_id) & (F.xxhash64(F.col(text_col)) == gone.gone_text), "left_anti")
