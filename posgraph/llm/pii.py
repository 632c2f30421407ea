"""Operator 4: personal data by weak supervision (DataFrame operations only).

Base kinds (email, ip, card, phone) are pattern matches with a check: ip parts
up to 255, cards of 16 to 19 digits by Luhn, phones of 8 to 15 digits; matches
that fail are dropped.  The method adds the kind ``secret``: runs of 20 or more
characters of ``[A-Za-z0-9_-]`` that hold a digit are candidates, and labelers
vote on each of them (or abstain):

* patterns: hexadecimal of 32 or more characters, or capitals, small letters and digits mixed;
* a gazetteer of words like "token" or "password" just before it;
* context: an assignment sign and quotes around it, or the signs of an address;
* shape: the share of digits.

Expectation-maximisation estimates each labeler's reliability and the
posterior of every vote pattern; a logistic regression on the span's features,
fitted to those posteriors, is the final classifier.  Votes and features are
yes/no, so both fits need only the number of spans of each combination (at
most ``2**len(FEATURES)`` rows), counted over the whole corpus by Spark.

Offsets are code points, end exclusive.  Rows: one per input row.  A null or
empty text has no spans.  Null and repeated ``doc_id`` are carried through.
Without candidates no secret is reported; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import stored

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
# The contract's patterns, each written so that it never backtracks over long runs:
# a match can only begin where a run of its characters begins (or where the last match ended).
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Only runs of 16 to 19 digits can pass the check; the look-around keeps them whole.
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"  # the digit is looked for in the match
# (kind, pattern, cheap test that a text may hold it)
PATTERNS = (("email", _EMAIL, "instr(text, '@') > 0"), ("ip", _IP, r"text rlike '[0-9]\\.[0-9]'"),
            ("card", _CARD, r"text rlike '[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]'"), ("phone", _PHONE, "instr(text, '+') > 0"),
            ("secret", _SECRET, r"text rlike '[A-Za-z0-9_-]{20}'"))
_BEFORE = 24  # characters before a candidate that the labelers see

FEATURES = {
    "hex": r"body rlike '^[0-9a-f]{32,}$'",
    "mixed": r"body rlike '[A-Z]' and body rlike '[a-z]' and body rlike '[0-9].*[0-9].*[0-9]'",
    "gazetteer": r"lower(before) rlike '(token|secret|key|password|passwd|pwd|bearer|credential)s?[^a-z]{0,5}$'",
    "assigned": r"before rlike '[=:] ?[\"\']?$'",
    "quoted": r"before rlike '[\"\']$' and after rlike '^[\"\']'",
    "address": r"before rlike '[/@.]$' or after rlike '^[@/]'",
    "digits": r"length(regexp_replace(body, '[^0-9]', '')) * 4 >= length(body)",
    "long": r"length(body) >= 32",
}
# Each labeler's vote from the features: 1 a secret, 0 not, None abstains.
LABELERS = (
    lambda f: 1 if f["hex"] or f["mixed"] else 0,
    lambda f: 1 if f["gazetteer"] else None,
    lambda f: 0 if f["address"] else 1 if f["assigned"] or f["quoted"] else None,
    lambda f: 1 if f["digits"] and f["long"] else 0,
)


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): the raw matches of every row, in order (stored).

    ``split`` gives the text between the matches, so the offsets are running
    sums of lengths; ``gap`` is the length of the text before a match.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    kinds = []
    for kind, pattern, test in PATTERNS:
        rows = rows.withColumn(f"_{kind}", F.when(F.expr(test), F.split("text", pattern, -1)).otherwise(none))
        rows = rows.withColumn(f"m_{kind}", F.when(F.size(f"_{kind}") > 1, F.regexp_extract_all(
            "text", F.lit(pattern), F.lit(0))).otherwise(none))
        gaps = F.col(f"_{kind}")
        after = F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0)))
        both = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(f"m_{kind}")).alias("g"), F.col(f"m_{kind}").alias("m"),
                            after.alias("a"))
        kinds.append(F.transform(both, _match(KINDS.index(kind), context=kind == "secret")))
    return stored(rows.select("row", "doc_id", F.concat(*kinds).alias("found")), "matches")


def _match(kind: int, context: bool):
    def make(x: Column) -> Column:
        before, after = ((F.right(x["g"], F.lit(_BEFORE)), F.left(x["a"], F.lit(2))) if context
                         else [F.lit(None).cast("string")] * 2)
        return F.struct(F.lit(kind).alias("kind"), F.length(x["g"]).alias("gap"), x["m"].alias("body"),
                        before.alias("before"), after.alias("after"))
    return make


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
        (F.substring(back, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substring(back, i, F.lit(1)).cast("int") / 5).cast("int")))
    return total % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("body", "[^0-9]", "")
    parts = F.transform(F.split("body", r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    card = F.length(digits).between(16, 19) & luhn(digits)
    kind = F.col("kind")
    return (F.when(kind == 1, ip).when(kind == 2, card).when(kind == 3, F.length(digits).between(8, 15))
            .when(kind == KINDS.index("secret"), F.col("body").rlike("[0-9]")).otherwise(F.lit(True)))


def spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, body, before, after) of the matches that pass their check, and all candidates."""
    one = found.where(F.size("found") > 0).select("row", F.posexplode("found").alias("at", "m")).select("row", "at", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("body")).over(upto)
    placed = one.withColumn("end", end).withColumn("start", F.col("end") - F.length("body"))
    return placed.where(_valid()).select("row", "kind", "start", "end", "body", "before", "after")


def estimate(counts: list[tuple[dict[str, bool], int]]) -> dict[str, float]:
    """Weights of the span classifier from the number of spans of each feature combination.

    Dawid-Skene EM on the labelers' votes (prior and one reliability per
    labeler and class, started from a majority vote), then logistic regression
    on the features against the posteriors.
    """
    votes = [[lf(f) for lf in LABELERS] for f, _ in counts]
    post = []
    for v in votes:
        said = [x for x in v if x is not None]
        post.append(0.5 if not said else 0.1 + 0.8 * sum(said) / len(said))
    for _ in range(50):
        size = [sum(n * (p if c else 1 - p) for (_, n), p in zip(counts, post, strict=True)) for c in (0, 1)]
        prior = (size[1] + 1) / (sum(size) + 2)
        right = [[0.0, 0.0] for _ in LABELERS]
        for k in range(len(LABELERS)):
            for c in (0, 1):
                heard = [(n * (p if c else 1 - p), v[k] == c) for (_, n), p, v in zip(counts, post, votes, strict=True)
                         if v[k] is not None]
                right[k][c] = (sum(w for w, ok in heard if ok) + 4) / (sum(w for w, _ in heard) + 5)
        post = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for k, x in enumerate(v):
                if x is not None:
                    hit = right[k][1] if x == 1 else 1 - right[k][1]
                    odds += math.log(hit / ((1 - right[k][0]) if x == 1 else right[k][0]))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    names = list(FEATURES)
    w = dict.fromkeys(["bias", *names], 0.0)
    total = sum(n for _, n in counts)
    for _ in range(500):
        grad = dict.fromkeys(w, 0.0)
        for (f, n), p in zip(counts, post, strict=True):
            z = w["bias"] + sum(w[k] for k in names if f[k])
            miss = n * (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) / total
            for k in ["bias", *[k for k in names if f[k]]]:
                grad[k] += miss
        for k in w:
            w[k] += 2.0 * (grad[k] - 0.001 * w[k])
    return w


def train(found_spans: DataFrame) -> dict[str, float]:
    """The span classifier, from the counts of all candidates of the corpus."""
    rows = (found_spans.where(F.col("kind") == KINDS.index("secret"))
            .groupBy(*[F.expr(e).alias(k) for k, e in FEATURES.items()]).count().collect())  # at most 2**8 rows
    counts = sorted(((tuple(bool(r[k]) for k in FEATURES), r["count"]) for r in rows))
    return estimate([(dict(zip(FEATURES, f, strict=True)), n) for f, n in counts]) if counts else {}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret for every row."""
    found = matches(docs)
    placed = stored(spans(found), "spans")
    w = train(placed)
    z = F.lit(w.get("bias", -1.0))
    for name, e in FEATURES.items():
        z = z + F.when(F.expr(e), w.get(name, 0.0)).otherwise(0.0)
    kept = placed.where((F.col("kind") < len(BASE)) | (z >= 0))
    by_row = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("s"),
                                     *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{n}") for k, n in enumerate(BASE)])
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")
    out = found.select("row", "doc_id").join(by_row, "row", "left")
    all_spans = F.coalesce("s", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))
    base = F.filter(all_spans, lambda x: x["kind"] < len(BASE))
    return out.select("doc_id", *[F.coalesce(f"n_{n}", F.lit(0)).cast("long").alias(f"n_{n}") for n in BASE],
                      F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(all_spans).alias("spans"),
                      F.size(F.filter(all_spans, lambda x: x["kind"] == KINDS.index("secret"))).cast("long").alias("n_secret"))
