"""Secret scans (operator 1), DataFrame functions only.

Base rules find assignments, access keys and hex runs.  The entropy scan adds
spans: candidate strings of a character class (base64 or hex alphabet) are
walked by a window of ``WINDOW`` characters whose symbol counts change by one
character out and one in; the running sum of c*log2(c) changes by those two
counts alone, and the walk ends at the first window that reaches the class's
threshold.  Such a candidate is reported unless the allow list suppresses it.
Placeholder words suppress only the piece between '/' and '=' that holds them.
Pieces of letters and digits alone are candidates of their own, with a
threshold by the alphabet they use, unless their run is reported or allowed.

No step is quadratic in the text: matches carry their strings, covering spans
are found by running maxima over sorted spans, running values are built in
blocks (steps a match: about 64, plus a share of the blocks), and no pattern repeats a group (Java would match it recursively).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules (kind, pattern, group whose length counts, least length).
# A run pattern with its least length built in finds the same runs as "+" followed by a length check.
BASE_RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]

WINDOW = 20
# Class -> (alphabet, candidate pattern, bits per character that a window must reach).
CLASSES = {
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
               r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 3.9),
    "hexmix": ("0123456789abcdefABCDEF", r"(?<![A-Za-z0-9+/_=-])[0-9a-fA-F]{20,}(?![A-Za-z0-9+/_=-])", 3.0),
}

# Pieces: runs of letters, digits and plus.  (what the piece looks like, bits a window must reach), first match wins.
# The bits are the 2 % quantile of the entropy of 20 random characters of that alphabet (3.38, 3.45, 3.64, 3.68;
# 40,000 draws), rounded down.
PIECE = (CLASSES["base64"][0].translate({ord(c): None for c in "/_=-"}), r"(?<![A-Za-z0-9+])[A-Za-z0-9+]{20,}")
PIECE_BITS = [
    (r"^([A-Z2-7]+|[a-z2-7]+)$", 3.35),    # base32
    (r"^([A-Z0-9]+|[a-z0-9]+)$", 3.4),     # letters of one case and digits
    (r"^[A-Za-z]+$", 3.6),                 # letters
    (r"", 3.65),
]

# A piece (between '/' and '=') of a run that holds a placeholder.
PLACEHOLDER = (r"(?i)(?<![a-z0-9+_-])[a-z0-9+_-]*?(example|placeholder|changeme|xxxx|0123456789|abcdefghij)"
               r"[a-z0-9+_-]*")

# Allow list: candidates that look random to a window but are no secrets.
ALLOW = [
    r"^(?!.*[A-Z][a-z][A-Z])[^0-9]*$",                               # words only, their case does not change at random
    r"^[^A-Za-z]*$",                                                 # numbers and rules only
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^([a-z]+=)?sha(1|256|384|512)-",                               # integrity hash, after its attribute's name or not
    r"^=?(?=.*/)(?!.*[^/]{16})[a-z0-9_=/-]*$",                       # lower-case path of names of 15 characters at most
    # words and numbers joined by dashes
    r"^(?!.*[A-Z][a-z][A-Z])(?!.*[A-Za-z][0-9])(?!.*[0-9][A-Za-z])(?=.*[A-Za-z0-9])[A-Za-z0-9_=-]*$",
]

_RUNNING_BLOCK = 128
_CUT = 4096


def _bound(value: Column, fn) -> Column:
    """``fn`` of a value computed once (a lambda's variable is, an expression inside a lambda is not)."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _running(values: Column, combine) -> Column:
    """Running values of an array of ints for an associative ``combine`` with identity 0.

    By blocks of ``_RUNNING_BLOCK``: within them from their own start, then
    with the blocks before.  An accumulator that holds an array would be
    copied at every step.
    """
    def total(v):
        return F.aggregate(v, F.lit(0), combine)

    def numbers(last):
        return F.sequence(F.lit(1), last)

    def blocks(v):
        count = F.ceil(F.size(v) / _RUNNING_BLOCK).cast("int")
        return F.transform(numbers(count), lambda i: F.slice(v, (i - 1) * _RUNNING_BLOCK + 1, F.lit(_RUNNING_BLOCK)))

    def joined(bs):
        inside = F.transform(bs, lambda b: F.transform(numbers(F.size(b)), lambda j: total(F.slice(b, F.lit(1), j))))
        before = _bound(F.transform(bs, total), lambda t: F.transform(
            numbers(F.size(t)), lambda i: total(F.slice(t, F.lit(1), i - 1))))
        return F.flatten(F.zip_with(inside, before, lambda b, at: F.transform(b, lambda x: combine(at, x))))

    return _bound(values, lambda v: F.when(F.size(v) > 0, _bound(blocks(v), joined)).otherwise(F.array().cast("array<int>")))


def _located(df: DataFrame, pattern: str, group: int, least: int, kind_no: int, kind: str, name: str) -> DataFrame:
    """Adds ``name``: (start, kind_no, kind, stop, run) of all leftmost matches whose ``group`` has ``least`` characters or more."""
    text = F.col("text")
    df = df.withColumn("m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn("g", F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col("m"))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size("m"))
    stops = _running(F.zip_with(gaps, "m", lambda p, m: F.length(p) + F.length(m)), lambda at, n: at + n)
    spans = F.transform(F.arrays_zip(F.col("m"), F.col("g"), stops.alias("stop")), lambda z: F.struct(
        (z["stop"] - F.length(z["m"])).alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(kind).alias("kind"),
        z["stop"].alias("stop"), z["m"].alias("run"), (F.length(z["g"]) >= least).alias("long")))
    spans = F.transform(F.filter(spans, lambda x: x["long"]), lambda x: x.dropFields("long"))
    none = F.array().cast("array<struct<start:int,kind_no:int,kind:string,stop:int,run:string>>")
    return df.withColumn(name, F.when(F.size("m") > 0, spans).otherwise(none)).drop("m", "g")


def best_window_entropy(s: Column, window: int = WINDOW, enough: Column | float = math.inf) -> Column:
    """Highest Shannon entropy (bits per character) of any ``window`` consecutive characters of ``s``, or the
    first that reaches ``enough``; a string shorter than the window gives 0."""
    part = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    enough = F.lit(float(enough)) if isinstance(enough, (int, float)) else enough
    start = F.struct(F.lit("").alias("w"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), enough.alias("enough"))

    def times(c, w):
        return F.length(w) - F.length(F.replace(w, c, F.lit("")))

    def step(acc, c):
        full = F.length(acc["w"]) == window
        gone = F.when(full, F.substring(acc["w"], 1, 1)).otherwise("")          # the character that leaves the window
        left = F.when(full, F.substring(acc["w"], 2, window)).otherwise(acc["w"])
        n_out, n_in = times(gone, acc["w"]), times(c, left)
        value = (acc["sum"] - F.element_at(part, n_out + 1) + F.element_at(part, F.greatest(n_out, F.lit(1)))
                 - F.element_at(part, n_in + 1) + F.element_at(part, n_in + 2))
        bits = F.when(F.length(acc["w"]) >= window - 1, F.lit(math.log2(window)) - value / window).otherwise(0.0)
        moved = F.struct(F.concat(left, c).alias("w"), value.alias("sum"), F.greatest(acc["best"], bits).alias("best"),
                         acc["enough"].alias("enough"))
        return F.when(acc["best"] >= acc["enough"], acc).otherwise(moved)

    return F.aggregate(F.split(s, ""), start, step, lambda acc: acc["best"])


def _allowed(part: Column) -> Column:
    out = F.length(part) < WINDOW
    for pattern in ALLOW:
        out = out | part.rlike(pattern)
    return out


def _is_secret(run: Column, threshold) -> Column:
    """Some part beside placeholders is not allow-listed and has a window of ``threshold(part)`` bits."""
    def secret(part):
        bits = threshold(part)
        return F.when(_allowed(part), F.lit(False)).otherwise(best_window_entropy(part, enough=bits) >= bits)
    return F.exists(F.split(run, PLACEHOLDER, -1), secret)


def _piece_bits(part: Column) -> Column:
    bits = F
    for pattern, value in PIECE_BITS[:-1]:
        bits = bits.when(part.rlike(pattern), F.lit(value))
    return bits.otherwise(F.lit(PIECE_BITS[-1][1]))


def _reach(spans: Column, counts) -> Column:
    """For each of the sorted spans: the furthest stop of the spans up to it that ``counts`` holds for."""
    return _running(F.transform(spans, lambda x: F.when(counts(x), x["stop"]).otherwise(0)),
                    lambda far, stop: F.greatest(far, stop))


def scan(docs: DataFrame) -> DataFrame:
    """(row, text, base, spans): ``docs``' columns as one struct, its text, and arrays of (start, kind_no, kind, stop).

    Offsets are code points, ends exclusive; spans are in order and include
    the base ones.  Null texts count as empty.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base_kinds, found = len(BASE_RULES), []
    rules = [*BASE_RULES, *[(kind, pattern, 0, WINDOW) for kind, (_, pattern, _) in CLASSES.items()], ("piece", PIECE[1], 0, WINDOW)]
    for no, (kind, pattern, group, least) in enumerate(rules):
        df = _located(df, pattern, group, least, no, kind, f"k{no}")
        found.append(f"k{no}")
    run_no, piece_no = base_kinds, len(rules) - 1
    df = df.withColumn("all", F.array_sort(F.concat(*found))).drop(*found)
    bits = {base_kinds + i: b for i, (_, _, b) in enumerate(CLASSES.values())}

    # runs: 1 reported, 2 allowed, 0 neither; a run inside a base span counts for nothing
    def state(x):
        secret = F
        for no, b in bits.items():
            secret = secret.when(x["x"]["kind_no"] == no, _is_secret(x["x"]["run"], lambda _, b=b: F.lit(b)))
        known = (F.when(~x["x"]["kind_no"].isin(list(bits)) | (x["reach"] >= x["x"]["stop"]), 0)
                 .when((x["x"]["kind_no"] == run_no) & _allowed(x["x"]["run"]), 2)
                 .when(secret.otherwise(False), 1).otherwise(0))
        return F.struct(x["x"]["start"].alias("start"), x["x"]["kind_no"].alias("kind_no"), x["x"]["kind"].alias("kind"),
                        x["x"]["stop"].alias("stop"), x["x"]["run"].alias("run"), x["reach"].alias("reach"), known.alias("state"))

    reach = _reach(F.col("all"), lambda x: x["kind_no"] < base_kinds)
    df = df.withColumn("all", F.transform(F.arrays_zip(F.col("all").alias("x"), reach.alias("reach")), state))
    over = _reach(F.col("all"), lambda x: x["state"] > 0)
    df = df.withColumn("all", F.zip_with("all", over, lambda x, far: x.withField("reach", F.greatest(x["reach"], far))))

    def kept(x):
        piece = F.when(x["reach"] >= x["stop"], F.lit(False)).otherwise(_is_secret(x["run"], _piece_bits))
        return F.when(x["kind_no"] == piece_no, piece).otherwise((x["kind_no"] < base_kinds) | (x["state"] == 1))

    bare = lambda x: x.dropFields("run", "reach", "state")
    return df.select(
        "row", "text", F.transform(F.filter("all", lambda x: x["kind_no"] < base_kinds), bare).alias("base"),
        F.transform(F.filter("all", kept), bare).alias("spans"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, by start, then kind).

    Null and empty texts have no spans (hash of the empty string); repeated rows
    and null doc_ids are rows like any other; other columns are ignored; an
    empty table gives none.  Texts of any length are scanned whole.
    """
    found = scan(docs.select(F.col("doc_id"), F.col("text")))
    count = lambda no: F.size(F.filter("base", lambda s: s["kind_no"] == no)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def _slice(blocks: Column, a: Column, b: Column) -> Column:
    """Characters [a, b) of a text cut into blocks of ``_CUT``."""
    i, j = F.floor(a / _CUT).cast("int"), F.floor(b / _CUT).cast("int")
    block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    start, stop = a - i * _CUT, b - j * _CUT
    between = F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
    return F.when(i == j, F.substring(block(i), start + 1, stop - start)).otherwise(
        F.concat(F.substring(block(i), start + 1, F.lit(_CUT)), between, F.substring(block(j), F.lit(1), stop)))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one) and ``n_chars`` brought up to date.

    Every row and every column stays, whatever its name; null texts stay null;
    texts without spans keep their ``n_chars``; an empty table stays empty.
    """
    df = scan(docs).withColumn("blocks", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0)))
    # each span gives the text since the furthest stop before it, and the mark if it starts there or later
    ends = F.transform("spans", lambda x: x["stop"])
    far = _running(ends, lambda f, stop: F.greatest(f, stop))
    before = F.concat(F.array(F.lit(0)), F.slice(far, F.lit(1), F.greatest(F.size("spans") - 1, F.lit(0))))
    parts = F.transform(F.arrays_zip(F.col("spans").alias("x"), before.alias("at")), lambda z: F.when(
        z["x"]["start"] >= z["at"], F.concat(_slice(F.col("blocks"), z["at"], z["x"]["start"]), F.lit(mark))).otherwise(""))
    rest = _slice(F.col("blocks"), F.array_max(far), F.length("text"))
    df = df.withColumn("clean", F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), rest)))
    hit = F.col("clean").isNotNull()
    new = {"text": F.when(hit, F.col("clean")).otherwise(F.col("row.text")).alias("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length("clean")).otherwise(F.col("row.n_chars")).cast("long").alias("n_chars")
    return df.select(*[new.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])
