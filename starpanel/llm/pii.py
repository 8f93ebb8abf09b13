"""Personal data (operator 9): base patterns and bootstrapped contextual extraction, with DataFrame functions only.

Base spans (e-mail, IP, card, phone) are seeds. Identifier-shaped tokens (those with a digit or @) are instances;
the words around an instance, other instances included, are its lexical patterns. A pattern's confidence is the mean
score of its instances' occurrences, shrunk by their number; an instance's score is the noisy-or of its patterns.
Instances of patterns above the threshold are promoted: they count as seeds do in the next round, until a round
promotes none. Promoted instances are added spans. Scores themselves take a fixed number of passes in a round: at
their fixed point a pattern's confidence would not depend on how many of its occurrences are unknown.

Positions come from splitting a text by the same pattern that extracts its matches: a match starts after all
segments and matches before it, summed by a window over the matches of one text. All patterns are possessive or
anchored to the start of a run, so any length of text takes linear time and constant stack.

Null and empty texts have no spans; a null id is kept; repeated rows each get their own result (rows are told apart
by place, not by id); an empty table gives an empty table; other columns are not looked at. No data is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starpanel.llm.common import Written, table

KINDS = ("email", "ip", "card", "phone")

# A match may start at the start of a run or where the last match ended; from any other place in a run it would
# meet the same end, so leftmost matches are the same as of the plain pattern.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    # Runs of digits with single separators are maximal: a run of under 13 digits is dropped here already.
    "card": r"[0-9](?:[\x20-]?[0-9]){12}(?:[\x20-]?[0-9])*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MATCH = "array<struct<kind:string,i:int,ahead:int,match:string,left:string,left2:string,right:string>>"
#: White-space-delimited tokens that hold a digit or @.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    parts = F.split(match, r"\.")
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255")))
        .when(kind == "card", F.length(digits).between(13, 19) & _luhn(digits))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(True)
    )


def _found(text: Column, kind: str, pattern: str) -> Column:
    """An array with each match of a text: kind, number, length of the segment before it, the match, words around it."""
    segments, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind != "token":
        pieces = F.arrays_zip(segments.alias("segment"), hits.alias("match"))
        return F.transform(
            F.filter(pieces, lambda p: p["match"].isNotNull()),
            lambda p, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("i"), F.length(p["segment"]).alias("ahead"), p["match"].alias("match"),
                F.lit("").alias("left"), F.lit("").alias("left2"), F.lit("").alias("right"),
            ),
        )

    def around(h: Column) -> Column:
        """The tokens of one text with the two words before each and the one after it, which may be tokens themselves."""
        none, far = F.array(F.lit("")), 2**31 - 1
        pieces = F.arrays_zip(
            h["segment"].alias("segment"), h["match"].alias("match"),
            F.concat(none, h["segment"]).alias("segment1"), F.concat(none, h["match"]).alias("match1"), F.concat(none, none, h["match"]).alias("match2"),
            F.slice(h["segment"], 2, far).alias("next"), F.slice(h["match"], 2, far).alias("next_match"),
        )
        # Backwards, so that words of any length are met at the start, in time that is linear in theirs.
        tail = lambda p: F.reverse(F.concat(p["match2"], p["segment1"], p["match1"], p["segment"]))
        head = lambda p: F.concat(p["next"], F.coalesce(p["next_match"], F.lit("")))
        return F.transform(
            F.filter(pieces, lambda p: p["match"].isNotNull()),
            lambda p, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("i"), F.length(p["segment"]).alias("ahead"), p["match"].alias("match"),
                F.reverse(F.regexp_extract(tail(p), r"^\s*+(\S++)", 1)).alias("left"),
                F.reverse(F.regexp_extract(tail(p), r"^\s*+\S++\s++(\S++)", 1)).alias("left2"),
                F.regexp_extract(head(p), r"^\s*+(\S++)", 1).alias("right"),
            ),
        )

    # One element holds both arrays, so that each is made once for a text.
    return F.transform(F.array(F.struct(segments.alias("segment"), hits.alias("match"))), around)[0]


def _word(c: Column) -> Column:
    """A context word as a pattern holds it: lower case, numbers masked, cue punctuation kept, the rest trimmed."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, "[0-9]+", "0"), r"^[^\p{L}0]+|[^\p{L}0:=#]+$", ""))


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per match or token, and one without a kind for each document: row, doc_id, kind, start, end, match, words."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    t = F.col("text")
    none = F.array().cast(_MATCH)
    digit = t.rlike("[0-9]")
    given = {"email": t.contains("@"), "ip": digit & t.rlike(r"[0-9]\.[0-9]"), "card": digit & t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": t.contains("+"), "token": digit | t.contains("@")}
    own = F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("ahead"), F.lit("").alias("match"), F.lit("").alias("left"), F.lit("").alias("left2"), F.lit("").alias("right")))
    every = F.concat(own, *(F.when(given[k], _found(t, k, p).cast(_MATCH)).otherwise(none) for k, p in [*PATTERNS.items(), ("token", TOKEN)]))
    return d.select("row", "doc_id", F.inline(every))


def placed(found: DataFrame) -> DataFrame:
    """Start and end of each match, in code points."""
    along = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("ahead") + F.length("match")).over(along)
    return found.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("match"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rounds: int = 2, support: int = 3, least: float = 0.9, least_digits: int = 6,
) -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans.

    ``rounds``: passes over the pattern-instance graph before instances are promoted, which is repeated until none is.
    ``support``: occurrences of seeds and promoted instances that a pattern needs.
    ``least``: confidence of a pattern whose instances are added. ``least_digits``: digits of an instance that is then
    added wherever it occurs, if it has no @; one with fewer is added only in patterns that are surer.
    """
    written = Written(docs.sparkSession)
    found = placed(matches(docs, id_col, text_col).repartition("row"))
    found = found.where(F.col("kind").isNull() | _valid(F.col("kind"), F.col("match")))
    # A token is a seed if a base span overlaps it: one began before its end and reaches beyond its start.
    w = Window.partitionBy("row").orderBy("start", "end", "kind")
    base = F.col("kind").isin(*KINDS)
    reach = F.max(F.when(base, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(base, F.col("start"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    found = found.withColumn("seed", F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False)))
    found = written(found.select("row", "doc_id", "kind", "start", "end", "match", "left", "left2", "right", "seed"), "matches")

    tokens = found.where(F.col("kind") == "token")
    l1, l2, r1 = _word(F.col("left")), _word(F.col("left2")), _word(F.col("right"))
    patterns = F.array_compact(F.array(
        F.when(l1.rlike(r"[:=#]$"), F.concat(F.lit("cue "), l1)),
        F.when((l1 != "") & (l2 != ""), F.concat_ws(" ", F.lit("left"), l2, l1)),
        F.when((l1 != "") & (r1 != ""), F.concat_ws(" ", F.lit("both"), l1, r1)),
    ))
    tokens = tokens.withColumn("patterns", patterns)
    graph = tokens.select(F.explode("patterns").alias("pattern"), F.col("match").alias("instance"), "seed")
    graph = graph.groupBy("pattern", "instance").agg(F.min("seed").alias("seed"), F.count("*").alias("times"))
    # A pattern with fewer occurrences than `support` can't reach it in any round.
    often = graph.groupBy("pattern").agg(F.sum("times").alias("n")).where(F.col("n") >= support)
    graph = written(graph.join(often, "pattern").select("pattern", "instance", "seed", "times", "n"), "graph")
    # With this shrinkage `support` occurrences that are all known reach `least` just so.
    whole = lambda c: c.contains("@") | (F.length(_digits(c)) >= least_digits)
    shrink, just = support * (1 / least - 1), least - 1e-9
    known = written(tokens.where("seed").select(F.col("match").alias("instance")).distinct(), "known-0")
    k = 0
    while True:
        marked = graph.join(known.withColumn("known", F.lit(1.0)), "instance", "left").fillna(0.0, ["known"])
        firm = marked.groupBy("pattern").agg(F.sum(F.col("known") * F.col("times")).alias("sum")).where(F.col("sum") >= support)
        near = written(marked.join(firm, "pattern"), f"near-{k}")
        confident = near.select("pattern", (F.col("sum") / (F.col("n") + shrink)).alias("confidence")).distinct()
        for _ in range(rounds - 1):
            scores = near.join(confident, "pattern").groupBy("instance").agg(
                F.max("known").alias("known"), (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("confidence")))))).alias("score")
            )
            scores = scores.select("instance", F.greatest("known", "score").alias("score"))
            confident = near.join(scores, "instance").groupBy("pattern").agg((F.sum(F.col("score") * F.col("times")) / (F.first("n") + shrink)).alias("confidence"))
        held = written(confident.where(F.col("confidence") >= just), f"held-{k}")
        reached = near.where(~F.col("seed")).join(held, "pattern", "left_semi").select("instance", "known").distinct()
        reached = written(reached.where(whole(F.col("instance"))), f"reached-{k}")
        promoted = reached.where("known = 0").select("instance")
        if promoted.isEmpty():
            break
        k += 1
        known = written(known.unionByName(promoted), f"known-{k}", replaces=f"known-{k - 1}")
        written.drop(f"near-{k - 1}")
    # Confidences only grow with what is known: the last round reaches what each before it did.
    added = reached.select("instance")
    place = ["row", "doc_id", F.lit("context").alias("kind"), "start", "end"]
    unseen = tokens.where(~F.col("seed"))
    new = unseen.join(added, tokens.match == added.instance, "left_semi").select(*place)
    # A short number says little by itself: it is added where it stands in a pattern, the surer the shorter it is, and promotes nothing.
    needs = 1 - (1 - least) * F.length(_digits(F.col("match"))) / least_digits - 1e-9
    short = unseen.where(~whole(F.col("match"))).select(*place, needs.alias("needs"), F.explode("patterns").alias("pattern")).join(held, "pattern")
    new = new.unionByName(short.where(F.col("confidence") >= F.col("needs")).drop("pattern", "confidence", "needs").distinct())

    spans = found.where(F.col("kind").isNull() | (F.col("kind") != "token")).select("row", "doc_id", "kind", "start", "end").unionByName(new)
    order = F.create_map(*(x for i, k in enumerate([*KINDS, "context"]) for x in (F.lit(k), F.lit(i))))[F.col("kind")]
    one = F.when(F.col("kind").isNotNull(), F.struct(order.alias("k"), "start", "end", "kind"))
    shown = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    out = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(one)).alias("all"))
    count = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", *(count(k) for k in [*KINDS, "context"]),
        F.sha2(shown(F.filter("all", lambda s: s["k"] < len(KINDS))), 256).alias("base_sha256"),
        shown(F.col("all")).alias("spans"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
