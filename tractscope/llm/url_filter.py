"""URL filter: host and path rules first, then logistic regression on character n-grams.

The n-grams of host and path are hashed into two blocks of weights. The model is trained on
a small table of labelled URLs and scores URLs in batches.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

SIZES = (3, 4, 5)
BITS = 15
# The training table is a small one by definition; more rows are refused, not dropped.
MAX_LABELLED = 100_000
ROUNDS, RATE, RIDGE = 400, 4.0, 2e-4
THRESHOLD = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


# --- n-grams ---------------------------------------------------------------------


def _ngrams(texts, block):
    """(text of each n-gram, its weight's index) for hosts (block 0) or paths (block 1).

    Texts get a mark before and behind; an empty text has no n-grams.
    """
    marked = [f"\x02{text}\x03" if text else "" for text in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    lengths = np.array([len(text) for text in marked], np.int64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    owners, indexes = [], []
    for n in SIZES:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) ^ codes[k : len(codes) - n + 1 + k]
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = owner[: len(h)] == owner[n - 1 :]
        owners.append(owner[: len(h)][whole])
        indexes.append((h[whole] >> np.uint64(64 - BITS)).astype(np.int64) + (block << BITS))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(indexes)


def features(hosts, paths):
    """Sparse rows: (row, index, value). Each block of a URL has length 1."""
    parts = []
    for block, texts in enumerate((hosts, paths)):
        owner, index = _ngrams(texts, block)
        keys, counts = np.unique(owner << (BITS + 1) | index, return_counts=True)
        owner, index = keys >> (BITS + 1), keys & ((1 << (BITS + 1)) - 1)
        norm = np.sqrt(np.bincount(owner, counts.astype(float) ** 2, minlength=len(texts)))
        parts.append((owner, index, counts / norm[owner]))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, hosts, paths):
        """Probability that each URL is to be blocked; 0 for one without host and path."""
        row, index, value = features(hosts, paths)
        total = np.bincount(row, self.weights[index] * value, minlength=len(hosts))
        empty = np.array([not h and not p for h, p in zip(hosts, paths, strict=True)], bool)
        return np.where(empty, 0.0, _sigmoid(total + self.bias))


def fit(hosts, paths, blocked) -> UrlModel:
    """Logistic regression by accelerated gradient descent; classes weigh alike."""
    y = np.asarray(blocked, float)
    if len(y) == 0 or y.min() == y.max():
        raise ValueError("labelled URLs of both kinds are needed")
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    row, index, value = features(hosts, paths)
    size = 2 << BITS
    weights, before, bias = np.zeros(size), np.zeros(size), 0.0
    for k in range(ROUNDS):
        ahead = weights + k / (k + 3) * (weights - before)
        miss = (_sigmoid(np.bincount(row, ahead[index] * value, minlength=len(y)) + bias) - y) * share
        slope = np.bincount(index, miss[row] * value, minlength=size) + RIDGE * ahead
        before, weights = weights, ahead - RATE * slope
        bias -= RATE * miss.sum()
    return UrlModel(weights.astype(np.float32), float(bias))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked") -> UrlModel:
    """Model from a small labelled table (``url_col``, ``label_col`` 1 or 0).

    Rows with a null url or label are not used. The rows come to the driver, which trains;
    more than ``MAX_LABELLED`` raise an error.
    """
    rows = labelled.select(
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
        F.col(label_col).cast("int").alias("label"),
    ).where(F.col(url_col).isNotNull() & F.col("label").isNotNull())
    found = rows.limit(MAX_LABELLED + 1).collect()
    if len(found) > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    found.sort(key=lambda r: (r.host, r.path, r.label))
    return fit([r.host for r in found], [r.path for r in found], [r.label for r in found])


# --- rules -------------------------------------------------------------------------


class RuleBook:
    """Rules ``host/path``; the longest that fits a URL decides.

    A rule fits its host and all its subdomains, if the URL's path starts with the rule's.
    """

    def __init__(self, rules: dict[str, str]):
        self.by_host = {}
        for rule, verdict in sorted(rules.items(), key=lambda x: (-len(x[0]), x[0])):
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append(("/" + path, rule, verdict))

    def find(self, host: str, path: str):
        """(rule, verdict) or (None, None)."""
        best, verdict, at = None, None, 0
        while True:
            for start, rule, said in self.by_host.get(host[at:], ()):
                if path.startswith(start):
                    if best is None or len(rule) > len(best):
                        best, verdict = rule, said
                    break
            dot = host.find(".", at)
            if dot < 0:
                return best, verdict
            at = dot + 1


def judge(
    urls: DataFrame,
    model: UrlModel,
    rules: dict[str, str],
    url_col: str = "url",
    keep: tuple[str, ...] = ("page_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``keep``, host, path, rule, verdict (allow or block) and score of every URL.

    The rule's verdict counts where one fits, else the model blocks from ``threshold`` on.
    A null URL or one without ``://`` has empty host and path, no rule and score 0, so it is
    allowed. Repeated rows are judged each. ``keep`` may hold any columns but those added.
    The model (a quarter of a megabyte) and the rules, a literal, travel with the function.
    """
    parts = urls.select(
        *keep, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    added = [
        StructField("rule", StringType()),
        StructField("verdict", StringType()),
        StructField("score", DoubleType()),
    ]
    schema = StructType([*parts.schema.fields, *added])
    book = RuleBook(rules)

    def run(batches):
        for batch in batches:
            hosts, paths = batch["host"].tolist(), batch["path"].tolist()
            scores = model.score(hosts, paths)
            found = [book.find(h, p) for h, p in zip(hosts, paths, strict=True)]
            said = np.where(scores >= threshold, "block", "allow")
            yield batch.assign(
                rule=pd.Series([rule for rule, _ in found], index=batch.index, dtype=object),
                verdict=pd.Series(
                    [verdict or by_score for (_, verdict), by_score in zip(found, said, strict=True)],
                    index=batch.index,
                    dtype=object,
                ),
                score=scores,
            )

    return parts.mapInPandas(run, schema)


# --- the labelled table used where none is given -------------------------------------

# Written by hand for this library: words of gambling, medicine, lending, adult, copied goods
# and malware sites as they occur in names, and words of ordinary ones. No word comes from a
# table that the filter is used on.
UNWANTED_WORDS = (
    "poker roulette blackjack jackpot lottery sportsbook viagra cialis pharma steroid "
    "replica knockoff porn sex xxx escort dating webcam hookup popunder popup clickbait banner "
    "loans payday lender prize giveaway crack warez keygen torrent malware phish botnet doorway"
).split()
ORDINARY_WORDS = (
    "news blog wiki library garden school city river music science history travel kitchen "
    "weather museum health sport review forum photo paper market village house recipes "
    "northern daily local open field bridge theatre journal study world people family "
    "engine system letter orchard painter station mountain harbour winter summer software "
    "council hospital university museum parish society archive project"
).split()
CONSONANTS, VOWELS = "bcdfghklmnprstvw", "aeiou"
TOP_DOMAINS = ("com", "net", "org", "info", "biz", "co", "eu", "us")
SECTIONS = ("articles", "view", "index", "category", "p", "topic", "read", "2019/05")


def example_urls(count: int = 4000, seed: int = 5) -> list[tuple[str, int]]:
    """A labelled table by rule: hosts of unwanted words, and of ordinary words and syllables.

    Both kinds share top-level domains, subdomains and paths, so only the names tell them
    apart. It stands in for a table of labelled URLs where none is given; the words it lacks
    are words the model has not learnt.
    """
    random = np.random.default_rng(seed)

    def pick(words):
        return str(words[random.integers(len(words))])

    rows = []
    for i in range(count):
        blocked = i % 2
        if blocked:
            name = pick(("-", "", "-")).join(pick(UNWANTED_WORDS) for _ in range(random.integers(1, 3)))
            name += pick(("", "", "", "24", "online", "-zone"))
        elif i % 3 == 0:
            name = pick(("-", "")).join(pick(ORDINARY_WORDS) for _ in range(random.integers(1, 3)))
        else:
            pairs = range(random.integers(2, 5))
            name = "".join(pick(CONSONANTS) + pick(VOWELS) + pick((*CONSONANTS, "")) for _ in pairs)
        host = pick(("", "", "www.", "shop.", "my.")) + f"{name}.{pick(TOP_DOMAINS)}"
        path = f"/{pick(SECTIONS)}/{random.integers(1, 100_000)}" + pick(("", "/", ".html"))
        rows.append((f"{pick(('http', 'https'))}://{host}{path}", blocked))
    return rows
