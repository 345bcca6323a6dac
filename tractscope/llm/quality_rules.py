"""Quality rules as a ledger: measurements and one failure bit for each rule.

Every rule is evaluated once for every text. What is kept is a matter of a policy, a named
set of rules, applied later to the stored bits; ablations of a policy need the bits alone.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tractscope.llm.words import Powers, kept_and_text, mixed, text_slices, tidy

SYMBOLS = b"#*$%&|<>"
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_lower", "n_exclaims",
]


def _flags(characters):
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def _repeated(keys):
    """Marks of keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    marks = np.zeros(len(keys), bool)
    marks[order] = np.r_[same, False] | np.r_[False, same]
    return marks


def measure_slice(s):
    """The measures of each text of a slice."""
    count = len(s.start)
    symbol, upper, lower = (
        _flags(x)[s.bytes] for x in (SYMBOLS, range(65, 91), range(97, 123))
    )
    out = {
        "n_words": s.n_words,
        "word_chars": s.totals(s.inside & ((s.bytes & 0xC0) != 0x80)),
        "n_symbols": s.totals(symbol),
        "n_upper": s.totals(upper),
        "n_lower": s.totals(lower),
        "n_exclaims": s.totals(s.bytes == 0x21),
    }
    # Lines with a word. A line begins where a text does and after each line break in it; of
    # texts that share a start, all but the last are empty.
    breaks = np.flatnonzero(s.bytes == 0x0A)
    begins = np.unique(np.r_[s.start, breaks + 1])
    begins = begins[begins < len(s.bytes)]
    text = np.searchsorted(s.start, begins, "right") - 1
    next_break = np.r_[breaks, len(s.bytes)][np.searchsorted(breaks, begins)]
    ends = np.minimum(s.end[text], next_break)
    words = np.r_[0, np.cumsum(s.inside)]
    full = words[ends] > words[begins]
    begins, ends, text = begins[full], ends[full], text[full]
    keys = mixed(s.hashes(begins, ends) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 2)
    first = np.unique(keys, return_index=True)[1]
    out["n_lines"] = np.bincount(text, minlength=count)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(text[first], minlength=count)
    # Words covered by a window of five that occurs twice in its text.
    at, h = s.windows()
    owner = s.word_text[at]
    keys = mixed(h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 2)
    twice = at[_repeated(keys)] if len(keys) > 1 else at[:0]
    steps = np.zeros(len(s.word_hash) + 6, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + 5, -1)
    covered = np.cumsum(steps)[: len(s.word_hash)] > 0
    out["n_repeat_words"] = np.bincount(s.word_text[covered], minlength=count)
    return out


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and the measures of every whole text.

    Null and empty texts measure 0 throughout. ``keep`` may hold any columns but those named
    like a measure.
    """
    kept = docs.select(*keep)
    source, place = kept_and_text(docs, keep, text_col)
    schema = StructType(
        [*kept.schema.fields, *(StructField(name, LongType()) for name in MEASURES)]
    )

    def run(batches):
        powers = Powers()

        def measured(batch):
            columns = {name: np.zeros(batch.num_rows, np.int64) for name in MEASURES}
            for at, s in text_slices(batch.column(place), powers):
                for name, values in measure_slice(s).items():
                    columns[name][at : at + len(values)] = values
            return pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    *(pa.array(columns[name]) for name in MEASURES),
                ],
                names=schema.names,
            )

        # Unlike a loop, this keeps no batch while the next one is read.
        return map(measured, batches)

    return source.mapInArrow(tidy(run), schema)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true. ``bit`` is its place in the ledger for good."""

    bit: int
    name: str
    fails: str


# Bits are never given to another rule. Ratios are compared as products of whole numbers.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_passages", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 20 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "capitals", "100 * n_upper > 50 * (n_upper + n_lower)"),
    Rule(6, "exclamations", "100 * n_exclaims > 20 * n_words"),
)
POLICIES = {
    "base-1": ("few_words", "repeated_passages"),
    "web-1": tuple(rule.name for rule in RULES),
}
BASE_POLICY, POLICY = "base-1", "web-1"


def policy_mask(policy: str, rules=RULES) -> int:
    bits = {rule.name: rule.bit for rule in rules}
    return sum(1 << bits[name] for name in POLICIES[policy])


def failure_bits(rules=RULES) -> Column:
    """All rules' failure bits in one number."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        failed = F.when(F.expr(rule.fails), F.lit(1 << rule.bit).cast("long")).otherwise(0)
        bits = bits.bitwiseOR(failed)
    return bits


def ledger(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """``keep``, all measures and ``failed_rules``, the bits of the rules a text fails."""
    return measure(docs, text_col, keep).withColumn("failed_rules", failure_bits())


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed_rules").bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does, from the ledger's bits alone.

    For each rule the number of rows that fail it (``failed``), that fail it and no other
    rule of the policy (``failed_alone``: what dropping the rule would bring back), and that
    would be kept without it. Rows are first counted by their bits, so at most one row for
    each combination of rules and task is shuffled.
    """
    mask = policy_mask(policy)
    counts = rows.groupBy(F.col("failed_rules").bitwiseAND(F.lit(mask)).alias("bits")).count()
    chosen = [rule for rule in RULES if rule.name in POLICIES[policy]]
    per_rule = F.explode(
        F.array(
            *(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in chosen)
        )
    )
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")

    def total(condition):
        return F.sum(F.when(condition, F.col("count")).otherwise(0))

    return counts.withColumn("r", per_rule).groupBy(F.col("r.rule").alias("rule")).agg(
        total(has).alias("failed"),
        total(alone).alias("failed_alone"),
        total(alone | (F.col("bits") == 0)).alias("kept_without"),
    )


def keep_documents(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The documents that pass the base rules and a policy, with all their columns."""
    inner = [f"doc_column_{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*inner)
    text = inner[docs.columns.index("text")]
    rows = ledger(renamed, text, tuple(inner))
    return rows.where(passes(BASE_POLICY) & passes(policy)).select(*inner).toDF(*docs.columns)
