"""Language by Bayesian evidence fusion.

A row's evidence is its text (hashed byte n-gram multinomials, one for each language), the
language that its markup declares, its address suffix, and its host. The text model is
fitted on a bounded sample of rows with a declared language. How often each language comes
with each declaration, suffix and host is counted over all rows by grouped aggregation of
the text's own posteriors; host counts are smoothed by those of the host's domain, these
by those of the whole corpus. The posterior is proportional to
text^temper * P(declared | language) * P(suffix | language) * P(language | host).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from gapweave.llm.counts import SLICE, summed_slices
from gapweave.llm.kernels import blocks, byte_grams, gram_inside, gram_sums, trimmed, utf8
from gapweave.llm.shared import discard, materialise

GRAM = 3
BITS = 16
#: Bound of the labelled sample for each language; every declared language has a model.
SAMPLE_ROWS = 2_000
#: Sampled rows that an n-gram must occur in to count for a language that has at least so many: what one row alone has, a text in
#: another language that is declared wrongly, say, teaches nothing.
MIN_ROWS, MIN_SAMPLE = 2, 20
#: Languages whose n-gram table is dense at a time (32 MB).
GROUP = 64
#: Weight of the text: neighbouring n-grams overlap, so their evidence counts less than in full.
TEMPER = 0.5
#: Pseudo-counts by which a host leans on its domain, a domain on the corpus, and for unseen declarations and suffixes.
HOST_WEIGHT, DOMAIN_WEIGHT, OTHER_WEIGHT = 10.0, 20.0, 1.0
#: A row is rejected if its best language has a smaller posterior, or if random bytes explain its text better: the mean
#: log-likelihood ratio of its n-grams, with FIT_SHRINK more that count 0, so that a few odd ones do not decide.
MIN_POSTERIOR = 0.5
MIN_FIT, FIT_SHRINK = -0.5, 32

_OPEN = re.compile(r"<(?:(!--)|(script|style)(?![\w-])|)", re.I)
#: What ends each kind of markup.
_CLOSE = {"!--": re.compile("-->"), "script": re.compile(r"</script\s*>", re.I), "style": re.compile(r"</style\s*>", re.I), "": re.compile(">")}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SPOKEN = _LETTER.copy()
_SPOKEN[[9, 10, 32]] = True


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased n-grams, and which of them count: those of letters and blanks that lie in one document.
    Numbers, codes and symbols speak for no language."""
    spoken = _SPOKEN[data]
    good = gram_inside(offsets, GRAM)
    for i in range(GRAM):
        good = good & spoken[i : len(spoken) - GRAM + 1 + i]
    return byte_grams(_LOWER[data], GRAM, BITS), good


class TextModel:
    """Languages and, for each n-gram, its log-probability in each language over that of random bytes: for each language
    the n-grams seen in it, their values, and the value of all others."""

    def __init__(self, languages: list[str], seen: list[np.ndarray], values: list[np.ndarray], unseen: list[float]):
        self.languages, self.seen, self.values, self.unseen = languages, seen, values, unseen
        self._made: tuple[int, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    def ratio(self, first: int) -> np.ndarray:
        """The dense table (n-grams, languages) of GROUP languages; the last one made stays."""
        if self._made is None or self._made[0] != first:
            self._made = None
            out = np.tile(np.array(self.unseen[first : first + GROUP]), (1 << BITS, 1))
            for j in range(out.shape[1]):
                out[self.seen[first + j], j] = self.values[first + j]
            self._made = (first, out)
        return self._made[1]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihood ratio of each document under each language, its number of n-grams and of letter bytes."""
        grams, good = _grams(data, offsets)
        scores = np.zeros((len(offsets) - 1, len(self.languages)))
        for first in range(0, len(self.languages), GROUP):
            values = self.ratio(first)[grams]
            values[~good] = 0
            scores[:, first : first + GROUP] = gram_sums(values, offsets, GRAM)
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        return scores, gram_sums(good, offsets, GRAM).astype(np.int64), letters[offsets[1:]] - letters[offsets[:-1]]


def sample(rows: DataFrame, most: int = SAMPLE_ROWS) -> dict[str, list[int]]:
    """For each declared language at most `most` ids, those of smallest hash; an id that comes often counts as often.

    All languages are read at once: rows under a hash that some 2 * most rows of their language lie under, and for a
    language that has too few of them (ids may repeat) again under a higher one.
    """
    named = materialise(rows.filter("id is not null and declared is not null and declared <> ''").select("id", "declared"), "declared-languages")
    count = {r["declared"]: r["count"] for r in named.groupBy("declared").count().collect()}
    languages = sorted(count)
    part = {k: min(1.0, 2 * most / count[name]) for k, name in enumerate(languages)}
    out: dict[str, list[int]] = {}
    while part:
        limits = [(k, languages[k], min((1 << 63) - 1, int(f * 2.0**64) - (1 << 63))) for k, f in part.items()]
        limits = F.broadcast(rows.sparkSession.createDataFrame(limits, "k int, declared string, top long"))
        own = named.join(limits, "declared").select("k", "id", F.xxhash64("id").alias("hash"), "top").filter("hash <= top")
        found = own.groupBy("k", "id", "hash").count().toArrow()
        kind, ids, keys, n = (found.column(c).to_numpy() for c in ("k", "id", "hash", "count"))
        order = np.lexsort((ids, keys, kind))
        kind, ids, n = kind[order], ids[order], n[order]
        for k, f in list(part.items()):
            a, b = np.searchsorted(kind, [k, k + 1])
            before = np.cumsum(n[a:b]) - n[a:b]
            if f < 1 and n[a:b].sum() < most:
                part[k] = min(1.0, 4 * f)
            else:
                out[languages[k]] = sorted(ids[a:b][before < most].tolist())
                del part[k]
    discard(named)
    return out


def fit(rows: DataFrame, ids: dict[str, list[int]]) -> TextModel:
    """Count the n-grams of the sampled rows, whole texts, in one pass without a shuffle of texts. The driver gets counts of
    n-grams, whose number the sample bounds."""
    languages, size = sorted(ids), 1 << BITS
    if not languages:
        return TextModel([], [], [], [])
    pairs = sorted((i, k) for k, name in enumerate(languages) for i in ids[name])
    known = rows.sparkSession.sparkContext.broadcast(np.array(pairs, np.int64).reshape(-1, 2))

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        pairs = known.value
        row_ids = batch.column(0).fill_null(-1).to_numpy()
        at = np.minimum(np.searchsorted(pairs[:, 0], row_ids), len(pairs) - 1)
        chosen = np.flatnonzero((pairs[at, 0] == row_ids) & batch.column(0).is_valid().to_numpy(zero_copy_only=False))
        if not len(chosen):
            return
        data, offsets = utf8(batch.column(1).take(pa.array(chosen)))
        kind = pairs[at[chosen], 1]
        for a, b in blocks(offsets):
            part = offsets[a : b + 1] - offsets[a]
            grams, good = _grams(data[offsets[a] : offsets[b]], part)
            label = (np.repeat(kind[a:b], np.diff(part))[: len(grams)] * size + grams)[good]
            yield label
            row = np.repeat(np.arange(b - a), np.diff(part))[: len(grams)][good]
            yield size * len(languages) + np.unique(row * (size * len(languages)) + label) % (size * len(languages))

    seen: list[list[np.ndarray]] = [[] for _ in languages]
    counts: list[list[np.ndarray]] = [[] for _ in languages]
    in_rows: list[list[np.ndarray]] = [[] for _ in languages]
    parts = dict(summed_slices(rows.select("id", "text"), 2 * size * len(languages), keys))
    for at in sorted(a for a in parts if a * SLICE < size * len(languages)):
        k, first = divmod(at * SLICE, size)
        there = np.flatnonzero(parts[at])
        seen[k].append((there + first).astype(np.int32))
        counts[k].append(parts[at][there])
        in_rows[k].append(parts[at + size * len(languages) // SLICE][there])
    grams, values, unseen = [], [], []
    for name, own, n, rows_ in zip(languages, seen, counts, in_rows):
        own, n = np.concatenate([np.zeros(0, np.int32), *own]), np.concatenate([np.zeros(0, np.int64), *n])
        if own.size and len(ids[name]) >= MIN_SAMPLE:
            known = np.concatenate(rows_) >= MIN_ROWS
            own, n = own[known], n[known]
        dense = np.full(size, 0.05)
        dense[own] += n
        total = dense.sum()
        grams.append(own)
        values.append(np.log(dense[own] / total) + np.log(size))
        unseen.append(float(np.log(0.05 / total) + np.log(size)))
    return TextModel(languages, grams, values, unseen)


_SHARE = StructType().add("l", IntegerType()).add("s", DoubleType())


def _textual(rows: DataFrame, model: TextModel) -> DataFrame:
    """rows without texts, with the text's scores and its own posterior, of that the languages l with a share s above 0."""
    names = [c for c in rows.columns if c != "text"]
    schema = rows.select(*names).schema.add("scores", ArrayType(DoubleType())).add("soft", ArrayType(_SHARE)).add("grams", LongType()).add("letters", LongType())
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        k = len(model.languages)
        for batch in batches:
            data, offsets = utf8(batch.column(len(names)))
            for a, b in blocks(offsets):
                scores, grams, letters = model.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                soft = np.exp(TEMPER * (scores - scores.max(1, keepdims=True))) if k else scores
                soft /= soft.sum(1, keepdims=True) if k else 1
                soft = np.round(soft, 6)
                of, kind = np.nonzero(soft)
                pairs = pa.StructArray.from_arrays([pa.array(kind, pa.int32()), pa.array(soft[of, kind], pa.float64())], ["l", "s"])
                bounds = pa.array(np.arange(b - a + 1) * k, pa.int32()), pa.array(np.searchsorted(of, np.arange(b - a + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(bounds[0], pa.array(np.round(scores, 6).ravel())), pa.ListArray.from_arrays(bounds[1], pairs)]
                yield pa.record_batch([c.slice(a, b - a) for c in batch.columns[: len(names)]] + [*lists, pa.array(grams), pa.array(letters)], schema.names)

    return rows.select(*names, "text").mapInArrow(trimmed(run), schema)


def _sums(rows: DataFrame, *by: str, name: str) -> DataFrame:
    """For each value of `by` the shares of each language added up, those above 0, as `name`."""
    sums = rows.select(*by, F.explode("soft").alias("x")).select(*by, "x.l", "x.s").groupBy(*by, "l").agg(F.sum("s").alias("s"))
    return sums.groupBy(*by).agg(F.collect_list(F.struct("l", "s")).alias(name))


def identify(rows: DataFrame, model: TextModel, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, declared, host, text_lang, lang, posterior, fit, rejected, carry) of every row.

    rows: id long, text, declared, suffix, host, domain (strings). Nulls in the last four are
    missing evidence: a null host or domain has the corpus' prior, a null declaration or suffix
    speaks for no language. A text without n-grams is decided by the rest; one without a letter, empty
    and null texts too, has no language of its own and is rejected. Rows that repeat an id are judged one by one; ties go to the
    language that sorts first. With no languages every row is rejected. An empty table gives an empty
    table.
    """
    k = len(model.languages)
    found = materialise(_textual(rows.select("id", "declared", "suffix", "host", "domain", *carry, "text"), model), "language-scores")
    if not k:
        return found.select("id", "declared", "host", F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("fit"), F.lit(True).alias("rejected"), *carry)
    some = found.filter("grams > 0")
    corpus = np.zeros(k) + OTHER_WEIGHT
    for row in some.select(F.explode("soft").alias("x")).groupBy("x.l").agg(F.sum("x.s").alias("s")).collect():
        corpus[row["l"]] += row["s"]
    share = corpus / corpus.sum()
    domains = _sums(some.filter("domain is not null"), "domain", name="above")
    hosts = _sums(some.filter("host is not null"), "host", "domain", name="own").join(domains, "domain", "left")
    hosts = hosts.select("host", F.coalesce("domain", F.lit("")).alias("of"), "own", "above")
    joined = found.withColumn("of", F.coalesce("domain", F.lit(""))).join(hosts, ["host", "of"], "left")
    for name in ("declared", "suffix"):
        joined = joined.join(_sums(some.filter(F.col(name).isNotNull()), name, name=f"{name}_sums"), name, "left")
    names, languages = ["id", "declared", "host", "scores", "grams", "letters", "own", "above", "declared_sums", "suffix_sums", *carry], model.languages

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """The sums of each row, and which rows have some."""
            out, there = np.zeros((len(column), k)), column.is_valid().to_numpy(zero_copy_only=False)
            column = column.drop_null()
            pairs = column.flatten()
            of = np.repeat(np.flatnonzero(there), column.value_lengths().to_numpy())
            out[of, pairs.field("l").to_numpy()] = pairs.field("s").to_numpy()
            return out, there[:, None]

        def given(column: pa.Array) -> np.ndarray:
            """log P(value | language), up to a factor that is the same for all languages."""
            own, there = sums(column)
            return np.where(there, np.log((own + OTHER_WEIGHT * share) / corpus), 0)

        def prior(host: pa.Array, domain: pa.Array) -> np.ndarray:
            (own, there), (above, has_domain) = sums(host), sums(domain)
            above = np.where(has_domain, (above + DOMAIN_WEIGHT * share) / (above.sum(1, keepdims=True) + DOMAIN_WEIGHT), share)
            return np.log(np.where(there, (own + HOST_WEIGHT * above) / (own.sum(1, keepdims=True) + HOST_WEIGHT), share))

        labels = np.array(languages, object)
        for batch in batches:
            scores, grams = batch.column(3).flatten().to_numpy().reshape(-1, k), batch.column(4).to_numpy()
            logs = TEMPER * scores + prior(batch.column(6), batch.column(7)) + given(batch.column(8)) + given(batch.column(9))
            odds = np.exp(logs - logs.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            best = odds.argmax(1)
            top = np.round(odds.max(1), 6)
            fit_ = np.round(scores[np.arange(len(best)), best] / (grams + FIT_SHRINK), 6)
            text_lang = np.where(grams > 0, labels[scores.argmax(1)], None)
            rejected = (batch.column(5).to_numpy() == 0) | (top < MIN_POSTERIOR) | (fit_ < MIN_FIT)
            arrays = [*batch.columns[:3], pa.array(text_lang, pa.string()), pa.array(labels[best], pa.string()), pa.array(top), pa.array(fit_), pa.array(rejected), *batch.columns[10:]]
            yield pa.record_batch(arrays, out.names)

    out = StructType.fromDDL("id long, declared string, host string, text_lang string, lang string, posterior double, fit double, rejected boolean")
    for field in found.select(*carry).schema:
        out = out.add(field)
    return joined.select(*names).mapInArrow(trimmed(fuse), out)


def of_documents(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """documents as evidence: lang is what was declared, source stands for the host; and carry."""
    return docs.select(*carry, F.col("doc_id").cast("long").alias("id"), "text", F.lower(F.split("lang", "[-_]")[0]).alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"), F.lit(None).cast("string").alias("domain"))


def of_pages(pages: DataFrame) -> DataFrame:
    """pages as evidence: html as it is, for without_markup(), the lang of its first html element, and the address. Rows with a
    null html or url have no text, declaration, or host."""
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    at = F.regexp_instr("html", F.lit(r"(?i)<html\b"))
    element = F.when(at > 0, F.substring_index(F.substr("html", at), ">", 1)).otherwise("")
    head = F.lower(F.regexp_extract(element, r"(?i)\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    blank = lambda c: F.when(c != "", c)
    rows = pages.select(F.col("page_id").cast("long").alias("id"), "html", blank(head).alias("declared"), blank(host).alias("host"))
    return rows.select("id", F.col("html").alias("text"), "declared", "host", F.coalesce(blank(domain), "host").alias("domain"), blank(F.regexp_extract("host", r"\.([^.]+)$", 1)).alias("suffix"))


def text_of(html: str) -> str:
    """The text between tags; each tag, comment, script and style becomes a blank. One scan from left to right:
    a kind of markup whose end is not found once has none further on either, so the time grows with the text."""
    out, at, endless = [], 0, set()
    for m in iter(lambda: _OPEN.search(html, at), None):
        out.append(html[at : m.start()])
        for kind in ((m[1] or m[2] or "").lower(), ""):  # a comment or script without an end is an ordinary tag
            if kind not in endless:
                if end := _CLOSE[kind].search(html, m.end() if kind else m.start()):
                    break
                endless.add(kind)
        else:
            end = None
        if end is None:  # no tag ends any more
            out.append(html[m.start() :])
            at = len(html)
            break
        out.append(" ")
        at = end.end()
    return "".join([*out, html[at:]])


def without_markup(rows: DataFrame) -> DataFrame:
    """rows with the text between the tags of their html; scripts, styles and comments go."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [h and text_of(h) for h in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(text, pa.string()), *batch.columns[2:]], ["id", "text", "declared", "host", "domain", "suffix"])

    return rows.select("id", "text", "declared", "host", "domain", "suffix").mapInArrow(trimmed(strip), "id long, text string, declared string, host string, domain string, suffix string")
