"""Secret scan: three base patterns plus sliding-window entropy, all DataFrame functions.

Base spans are the leftmost non-overlapping matches of each kind. The entropy
method adds spans: a candidate is a maximal run of base64-like characters; the
narrowest class holding all of it (hex, alphanumeric, base64) gives the alphabet
and the threshold. A window slides over the run, and the symbol counts and the
sum of c*log2(c) are updated for the one symbol that enters and the one that
leaves. That sum is kept in integers (scaled by 2^20), so it never drifts. The
span runs from the first to the last window at or above the threshold. Runs on
the allow-list, and spans that lie within a base span, add nothing.

Defined results: null text counts as empty; repeated rows give repeated results;
an empty table gives an empty result; only the named columns are read, and on
output the operator's columns replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 20
BLOCK = 256  # matches or spans that are gone through one by one
CHUNK = 4096  # characters of a text that are walked through to cut it
SCALE = 1 << 20

# The base patterns of the contract, by kind.
BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",  # a maximal run of 20 characters or more
    "hex": r"[0-9a-f]{24,}",
}
ASSIGN_MIN = 6
# Alphabets, and the least entropy in bits of a window of 20 characters.
CLASSES = {
    "hex": ("0123456789abcdef", 3.0),
    "alnum": ("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.4),
    "base64": ("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/=_-", 3.7),
}
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
#: What can never be a key: no digit or no letter at all; UUIDs; paths and slugs of
#: plain lower-case words or numbers; stated placeholders.
ALLOW = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^/?([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8})([/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}))*/?$",
    r"(?i)example|placeholder|dummy|sample|xxxx",
)


def entropy_terms(window: int = WINDOW) -> list[int]:
    """c*log2(c) for c = 0..window+1, scaled to integers."""
    return [0] + [round(c * math.log2(c) * SCALE) for c in range(1, window + 2)]


def most_terms(window: int, least_bits: float) -> int:
    """The largest sum of terms at which a window still has least_bits of entropy."""
    return math.floor(window * (math.log2(window) - least_bits) * SCALE)


def _blocks(items: Column) -> Column:
    """An array in slices of BLOCK items."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(BLOCK))
    return F.transform(starts, lambda i: F.slice(items, i + 1, F.lit(BLOCK)))


def _outside(added: Column, base: Column) -> Column:
    """The spans of added that lie in no span of base (ordered by start); a block of base is entered only where it can hold the span."""
    blocks = F.transform(_blocks(base), lambda b: F.struct(
        b.alias("spans"), F.array_min(F.transform(b, lambda x: x["start"])).alias("start"),
        F.array_max(F.transform(b, lambda x: x["end"])).alias("end")))
    holds = lambda b, a: (a["start"] >= b["start"]) & (a["end"] <= b["end"])
    inside = lambda bs, a: F.exists(bs, lambda b: F.coalesce(
        holds(b, a) & F.exists(b["spans"], lambda x: holds(x, a)), F.lit(False)))
    return F.transform(F.array(blocks), lambda bs: F.filter(added, lambda a: ~inside(bs, a)))[0]


def _positions(text: Column, pattern: str) -> Column:
    """Array of (m, start, end): matches of the pattern with code point offsets."""
    lit = F.lit(pattern)
    matches = F.regexp_extract_all(text, lit, F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<m:string,start:bigint,end:bigint>>")
    zipped = F.zip_with(
        matches,
        F.slice(pieces, F.lit(1), F.size(matches)),
        lambda m, p: F.struct(m.alias("m"), F.length(p).cast("bigint").alias("gap")),
    )

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        one = F.struct(x["m"].alias("m"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def by_block(all_matches):
        """Offsets within blocks of matches, then blocks end to end: an array that grows one by one stays short."""
        blocks = _blocks(all_matches)
        zero = F.lit(0).cast("bigint")
        lengths = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda n, x: n + x["gap"] + F.length(x["m"])))
        begins = F.aggregate(
            lengths, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(F.zip_with(blocks, begins, lambda b, at: F.aggregate(
            b, F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])))

    found = F.transform(F.array(zipped), by_block)[0]  # an array of one names the matches, so they are found once
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _of_kind(found: Column, kind: str) -> Column:
    return F.transform(
        found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    )


def _hot_windows(run: Column, alphabet: str, least_bits: float, window: int) -> Column:
    """(first, last): start of the first and last window of run at or above the threshold, or -1.

    The run is turned into symbol numbers once. Counts are bit fields of a few longs, so a step
    changes two fields and reads symbols by index: its cost does not grow with the run.
    """
    terms = F.array(*[F.lit(x).cast("bigint") for x in entropy_terms(window)])
    bits = (window + 1).bit_length()
    per = 62 // bits  # fields of a long
    cells = -(-len(alphabet) // per)
    long = lambda x: F.lit(x).cast("bigint")
    place = lambda k: F.when(k > 0, F.struct(
        F.floor((k - 1) / per).cast("int").alias("cell"), ((k - 1) % per * bits).cast("int").alias("shift")))
    symbols = F.transform(F.split(run, ""), lambda c: place(F.position(c, F.lit(alphabet))))
    count = lambda counts, s: F.call_function("shiftright", F.get(counts, s["cell"]), s["shift"]).bitwiseAND(long((1 << bits) - 1)).cast("int")
    unit = lambda s, k: F.when(s["cell"] == k, F.call_function("shiftleft", long(1), s["shift"])).otherwise(long(0))
    zero = F.struct(
        F.array_repeat(long(0), cells).alias("counts"), long(0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last")
    )

    def step(acc, x):
        came, gone, i = x["came"], x["gone"], x["i"]
        c_in, c_out = count(acc["counts"], came), count(acc["counts"], gone)
        # one symbol enters, one leaves: only their two counts change
        same = F.coalesce((came["cell"] == gone["cell"]) & (came["shift"] == gone["shift"]), F.lit(False))
        changed = F.when(same, long(0)).otherwise(
            F.get(terms, c_in + 1) - F.get(terms, c_in)
            + F.coalesce(F.get(terms, c_out - 1) - F.get(terms, c_out), long(0))
        )
        total = acc["sum"] + changed
        counts = F.transform(acc["counts"], lambda c, k: c + unit(came, k) - unit(gone, k))
        hot = (i >= window) & (total <= most_terms(window, least_bits))
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & (acc["first"] < 0), i - window).otherwise(acc["first"]).alias("first"),
            F.when(hot, i - window).otherwise(acc["last"]).alias("last"),
        )

    def slide(s):
        """s: symbols of the run; each is met with its number and the symbol that leaves when it enters."""
        moves = F.transform(s, lambda came, i: F.struct(
            came.alias("came"), F.get(s, i - window).alias("gone"), (i + 1).alias("i")))
        return F.aggregate(moves, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    return F.transform(F.array(symbols), slide)[0]  # an array of one names the symbols, so they are made once


def find_secrets(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs + base, spans: arrays of (kind, start, end) in code points, by start, then kind.

    spans holds the base spans and those of kind 'entropy'.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kinds = [*BASE, "entropy"]
    ordered = lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"),
            F.array_position(F.array(*map(F.lit, kinds)), x["kind"]).alias("rank"),
            x["kind"].alias("kind"), x["end"].alias("end")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    assign = F.filter(
        _positions(text, BASE["assign"]),
        lambda x: F.length(F.regexp_extract(x["m"], BASE["assign"], 2)) >= ASSIGN_MIN,
    )
    base = F.concat(
        _of_kind(assign, "assign"),
        _of_kind(_positions(text, BASE["access"]), "access"),
        _of_kind(_positions(text, BASE["hex"]), "hex"),
    )
    # a possessive repeat matches the same runs, without a stack frame for each segment of a long path
    shapes = [p.replace(")*/?$", ")*+/?$") for p in ALLOW]
    allowed = lambda m: F.exists(F.array(*map(F.lit, shapes)), lambda p: F.regexp_like(m, p))
    runs = F.filter(_positions(text, CANDIDATE), lambda x: ~allowed(x["m"]))

    def scored(x):
        hot = [_hot_windows(x["m"], *CLASSES[c], window) for c in CLASSES]
        best = (
            F.when(x["m"].rlike("^[0-9a-f]+$"), hot[0]).when(x["m"].rlike("^[0-9A-Za-z]+$"), hot[1]).otherwise(hot[2])
        )
        return F.struct(x["start"].alias("start"), best.alias("hot"))

    high = F.filter(F.transform(runs, scored), lambda x: x["hot"]["first"] >= 0)
    added = F.transform(high, lambda x: F.struct(
        F.lit("entropy").alias("kind"),
        (x["start"] + x["hot"]["first"]).cast("bigint").alias("start"),
        (x["start"] + x["hot"]["last"] + window).cast("bigint").alias("end")))
    helper = "_" + max(docs.columns, key=len)  # a name that docs has not
    out = docs.withColumn("base", ordered(base)).withColumn(helper, added)
    fresh = _outside(F.col(f"`{helper}`"), F.col("base"))
    return out.withColumn("spans", ordered(F.concat(F.col("base"), fresh))).drop(helper)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every found span, overlapping ones merged, replaced by the mark; null text stays null."""
    names = docs.columns
    found = find_secrets(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).alias("_t")), "_t")
    zero = F.lit(0).cast("bigint")

    def step(acc, s):
        """A span that starts past all earlier ones closes the gap before it; others only push the end."""
        gap = F.array(F.struct(acc["at"].alias("a"), s["start"].alias("b")))
        gaps = F.when(s["start"] >= acc["at"], F.concat(acc["gaps"], gap)).otherwise(acc["gaps"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), gaps.alias("gaps"))

    def kept(spans):
        """The gaps (a, b) between merged spans: by blocks, each begun at the greatest end before it."""
        none = F.array().cast("array<struct<a:bigint,b:bigint>>")
        blocks = _blocks(spans)
        tops = F.transform(blocks, lambda b: F.coalesce(F.array_max(F.transform(b, lambda x: x["end"])), zero))
        before = F.aggregate(
            tops, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, t: F.struct(F.greatest(acc["at"], t).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        gaps = F.flatten(F.zip_with(blocks, before, lambda b, at: F.aggregate(
            b, F.struct(at.alias("at"), none.alias("gaps")), step, lambda acc: acc["gaps"])))
        last = F.struct(F.array_max(F.transform(spans, lambda x: x["end"])).alias("a"), F.length("_t").cast("bigint").alias("b"))
        return F.concat(gaps, F.array(last))

    def piece(chunks, g):
        """Code points a to b, from chunks of CHUNK, so that no cut walks the text from its start."""
        whole = lambda x: x.cast("int")
        i, j = whole(F.floor(g["a"] / CHUNK)), whole(F.floor((g["b"] - 1) / CHUNK))
        at, end = whole(g["a"] - i * CHUNK), whole(g["b"] - j * CHUNK)
        one = F.substring(F.get(chunks, i), at + 1, end - at)
        more = F.concat(
            F.substring(F.get(chunks, i), at + 1, F.lit(CHUNK)),
            F.array_join(F.slice(chunks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
            F.substring(F.get(chunks, j), F.lit(1), end),
        )
        return F.when(g["b"] <= g["a"], F.lit("")).when(i == j, one).otherwise(more)

    chunks = F.regexp_extract_all(F.col("_t"), F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    clean = F.transform(F.array(chunks), lambda ch: F.array_join(F.transform(kept(F.col("spans")), lambda g: piece(ch, g)), mark))[0]
    found = found.withColumn("_clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("_t")))
    return found.select(*[(F.col("_clean") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names])


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
        _digest(F.col("spans")).alias("spans"),
        count("entropy").alias("n_entropy"),
    )
