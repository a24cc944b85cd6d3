"""URL filter: gradient-boosted trees on lexical features and suffix statistics."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .tokens import buffers

#: Labelled URLs used for training, at most; suffix statistics are of all of them.
MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, L2 = 60, 3, 0.2, 32, 1.0
#: Parts of the labelled URLs; a training row's suffix rate is that of the parts it isn't in.
FOLDS = 5
#: Rows at the overall rate that each suffix is given besides its own.
PRIOR = 20
THRESHOLD = 0.5
LEXICAL = ("length", "depth", "digit_ratio", "entropy", "parameters", "parameter_chars", "host_length", "host_labels", "host_hyphens", "host_digits", "host_entropy", "https", "fragment", "extension")
FEATURES = (*LEXICAL, "suffix_rate", "suffix_share")
#: Names of advertising, gambling, adult, drug and spam sites, which label URLs where no labels are given.
BLOCKED_NAMES = r"(?i)^[a-z]+://([^/?#]*[.-])?(casino|bets?|poker|pills?|pharma|viagra|adult|xxx|porn|spam|ads|track|clickbait|warez|torrent)([.-][^/?#]*)?([/?#:]|$)"
_PARTS = r"(?s)^(?:(?P<scheme>[A-Za-z][A-Za-z0-9+.\-]*):)?(?://(?:[^/?#@]*@)?(?P<host>[^/?#:]*)(?::[^/?#]*)?)?(?P<path>[^?#]*)(?:\?(?P<query>[^#]*))?(?:#(?P<fragment>.*))?$"


def suffix(url: Column) -> Column:
    """The last label of the host in lower case, '' without one."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:]*?([^/?#:.]*)\.?(?::[^/?#]*)?(?:[/?#]|$)", 1)


def entropies(column: pa.Array) -> np.ndarray:
    """Bits a byte of each text; 0 for an empty one."""
    offsets, data = buffers(column)
    out = np.zeros(len(column))
    for i in range(0, len(column), 2048):
        ends = offsets[i : i + 2049]
        size = np.diff(ends)
        row = np.repeat(np.arange(len(size)), size)
        seen = np.bincount(row * 256 + data[ends[0] : ends[-1]], minlength=len(size) * 256).reshape(-1, 256)
        p = seen / np.maximum(size, 1)[:, None]
        out[i : i + len(size)] = -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0).sum(axis=1)
    return out


def lexical(urls: pa.Array) -> np.ndarray:
    """The features that need no statistics, a row for each URL; a null counts as empty.  Any text has a path at least."""
    urls = urls.cast(pa.large_string()).fill_null("")
    parts = pc.extract_regex(urls, _PARTS)
    scheme, host, path, query, fragment = (pc.struct_field(parts, x).fill_null("") for x in ("scheme", "host", "path", "query", "fragment"))
    length = pc.utf8_length(urls).to_numpy(zero_copy_only=False)
    count = lambda x, pattern: pc.count_substring_regex(x, pattern)
    columns = [
        length, count(path, "[^/]+"), count(urls, r"\p{Nd}").to_numpy(zero_copy_only=False) / np.maximum(length, 1), entropies(urls),
        count(query, "[^&;]+"), pc.utf8_length(query), pc.utf8_length(host), count(host, "[^.]+"), count(host, "-"), count(host, r"\p{Nd}"), entropies(host),
        pc.equal(pc.utf8_lower(scheme), "https"), pc.greater(pc.utf8_length(fragment), 0), pc.match_substring_regex(path, r"\.\w{1,5}$"),
    ]
    return np.stack([np.asarray(c.to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c, float) for c in columns], axis=1)


@dataclass
class Trees:
    """Bin edges and full trees of one depth; each has a feature and a bin for every inner node."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1), np.int64))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH)))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = self.binned(x)
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, f[node]] > c[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


@dataclass
class Model:
    """The trees, the share of bad URLs, and a table (suffix, suffix_rate, suffix_share) over all labelled URLs."""

    trees: Trees
    rate: float
    suffixes: DataFrame


def train(x: np.ndarray, bad: np.ndarray, trees: int = TREES) -> Trees:
    """Second-order boosting of the logistic loss with histogram trees of fixed depth; nothing is random.

    Without rows, or with rows of one kind only, there is no tree and every URL has the base probability.
    """
    bad = bad.astype(float)
    rate = float(np.clip(bad.mean() if len(bad) else 0.0, 1e-4, 1 - 1e-4))
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for i in range(x.shape[1])]
    model = Trees(edges, float(np.log(rate / (1 - rate))))
    if len(set(bad.tolist())) < 2:
        return model
    binned, total = model.binned(x), np.full(len(x), model.base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - bad, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS, np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for i in range(x.shape[1]):
                at = (node - first) * BINS + binned[:, i]
                gs, hs = (np.bincount(at, w, width * BINS).reshape(width, BINS) for w in (g, h))
                gl, hl = gs.cumsum(1), hs.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga**2 / (ha + L2)
                c = gain.argmax(1)
                better = gain[np.arange(width), c] > best
                best = np.where(better, gain[np.arange(width), c], best)
                feature[first : first + width][better], cut[first : first + width][better] = i, c[better]
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > cut[node])
        at = node - (2**DEPTH - 1)
        leaf = -RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + L2)
        total += leaf[at]
        made.append((feature, cut, leaf))
    model.feature, model.cut, model.leaf = (np.array([t[i] for t in made]) for i in range(3))
    return model


def learn(pages: DataFrame, labels: DataFrame | None = None, bound: int = MAX_LABELLED) -> Model:
    """A model whose trees learn from at most `bound` labelled URLs, in the order of a hash of the URL.

    labels: (url, bad).  Without them the URLs of `pages` are labelled by BLOCKED_NAMES, a list of site names.  Null URLs
    and labels teach nothing; of several labels of one URL the bad one counts.  The statistics of suffixes, their share
    of all URLs and of bad ones, are over all labelled URLs; a training row's rate leaves out the part it is in.
    """
    if labels is None:
        labels = pages.where("url is not null").select("url", F.col("url").rlike(BLOCKED_NAMES).cast("int").alias("bad"))
    labelled = labels.where("url is not null and bad is not null").groupBy("url").agg(F.max("bad").cast("long").alias("bad"))
    labelled = labelled.select("url", "bad", suffix(F.col("url")).alias("suffix"), F.pmod(F.xxhash64("url", F.lit(FOLDS)), F.lit(FOLDS)).alias("fold"))
    folds = written(labelled.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("bad").alias("b")), "folds")
    total, bad = folds.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    rate = min(max(bad / total if total else 0.0, 1e-4), 1 - 1e-4)
    each = folds.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    smooth = lambda b, n: (b + F.lit(PRIOR * rate)) / (n + F.lit(PRIOR))
    suffixes = written(each.select("suffix", "n", "b", smooth(F.col("b"), F.col("n")).alias("suffix_rate"), (F.col("n") / F.lit(max(total, 1))).alias("suffix_share")), "suffixes")
    chosen = labelled.orderBy(F.xxhash64("url"), "url").limit(bound)
    rows = chosen.join(suffixes, "suffix").join(folds.toDF("suffix", "fold", "own_n", "own_b"), ["suffix", "fold"])
    rows = rows.select("url", "bad", smooth(F.col("b") - F.col("own_b"), F.col("n") - F.col("own_n")).alias("r"), "suffix_share").orderBy(F.xxhash64("url"), "url").toArrow()  # `bound` rows at most
    url = rows["url"].combine_chunks()
    x = np.column_stack([lexical(pa.array(url, pa.string())), np.asarray(rows["r"], float), np.asarray(rows["suffix_share"], float)])
    return Model(train(x, np.asarray(rows["bad"], float)), rate, suffixes.select("suffix", "suffix_rate", "suffix_share"))


def score(pages: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, score, blocked) of each row: the probability that the URL is bad, and whether it reaches the threshold.

    A null URL scores null and isn't blocked; an empty one is scored like any text.  Repeated rows are scored each.
    Extra columns are ignored; an empty table gives an empty result.  A suffix that no label had counts as one at the
    overall rate.
    """
    trees = model.trees

    def run(batches):
        for batch in batches:
            urls = batch.column(1)
            x = np.column_stack([lexical(urls), np.asarray(batch.column(2)), np.asarray(batch.column(3))])
            p = np.round(trees.probability(x), 9)
            null = np.asarray(urls.is_null())
            yield pa.RecordBatch.from_arrays([batch.column(0), urls, pa.array(p, mask=null), pa.array((p >= threshold) & ~null)], names=["page_id", "url", "score", "blocked"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", suffix(F.coalesce("url", F.lit(""))).alias("suffix"))
    rows = rows.join(model.suffixes, "suffix", "left").select("page_id", "url", F.coalesce("suffix_rate", F.lit(model.rate)).alias("r"), F.coalesce("suffix_share", F.lit(0.0)).alias("s"))
    return rows.mapInArrow(run, "page_id bigint, url string, score double, blocked boolean")
