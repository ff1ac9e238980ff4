"""Which words each transcript mentions: counted in the text, or looked up by tokens, without shuffling any text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import words as W
from earshot.session import fits_broadcast, materialize

# Words of one ticker that are counted in every text one by one; for more of them tokens are looked up.
FEW_WORDS = 64

# First characters of a substring that tokens are found by.
GRAM = 3
TOKEN = r"(?U)[\p{Alpha}\p{Mn}\p{Me}\p{Mc}\p{Digit}\p{Pc}\p{IsJoin_Control}]+"


def whole_word(lower_text: Column, word: Column) -> Column:
    """Whole-word literal, the slash kept as text."""
    return W.says_word(lower_text, F.lower(word)).cast("int")


def variant_count(lower_text: Column, word: Column) -> Column:
    """Mentions of any slash-separated variant; overlapping variants count twice."""
    return W.count_variants(lower_text, W.word_variants(word))


def substring(lower_text: Column, word: Column) -> Column:
    return F.contains(lower_text, F.lower(word)).cast("int")


def mention_hits(docs: DataFrame, vocab: DataFrame, measure=whole_word, *, key: str = "doc_id",
                 keep: tuple[str, ...] = (), text: str = "content") -> DataFrame:
    """Rows (ticker, word, key, keep..., hits) for every transcript and vocabulary word with hits > 0.

    vocab holds the (ticker, word) pairs to look for; a pair with a null is none. The words of a ticker that has few are
    broadcast and counted in each of its texts, where the text is read. Of a ticker with many, or where the words do not
    fit a broadcast, the runs of tokens in a text are looked up by equality. Both give the same hits, for any number of
    words. Rows that share a key count apart; null texts have no hits.
    """
    pairs = vocab.select("ticker", "word").where(F.col("ticker").isNotNull() & F.col("word").isNotNull()).distinct()
    # Written first: the sizes below decide the plan, and the optimizer knows them.
    words = materialize(pairs.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ticker"))), "vocabulary")
    few, many = words.where(F.col("n") <= FEW_WORDS), words.where(F.col("n") > FEW_WORDS).drop("n")
    if few.isEmpty() or not fits_broadcast(few, ("ticker", "word")):
        return looked_up(docs, words.drop("n"), measure, key, keep, text)
    hits = counted(docs, few, measure, key, keep, text)
    if many.isEmpty():
        return hits
    tickers = many.select("ticker").distinct()
    if fits_broadcast(tickers, ("ticker",)):
        docs = docs.join(F.broadcast(tickers), "ticker", "left_semi")
    return hits.unionByName(looked_up(docs, many, measure, key, keep, text))


def counted(docs: DataFrame, words: DataFrame, measure, key: str, keep: tuple[str, ...], text: str) -> DataFrame:
    """mention_hits for words that fit a broadcast: every word of its ticker is counted in each text."""
    listed = words.groupBy("ticker").agg(F.collect_list("word").alias("_words"))
    lower = docs.where(F.col(text).isNotNull()).select("ticker", key, *keep, F.lower(text).alias("_lower"))
    per_word = F.transform("_words", lambda w: F.struct(w.alias("word"), measure(F.col("_lower"), w).alias("hits")))
    return lower.join(F.broadcast(listed), "ticker").select(
        "ticker", key, *keep, F.inline(F.filter(per_word, lambda h: h["hits"] > 0))).select("ticker", "word", key, *keep, "hits")


def looked_up(docs: DataFrame, vocab: DataFrame, measure, key: str, keep: tuple[str, ...], text: str) -> DataFrame:
    """mention_hits for any number of words.

    Each text is cut into its tokens and the gaps between them once, where it is read; at every place the runs of as
    many tokens as some word has are looked up by equality. Only narrow rows meet the vocabulary, and only hits come out;
    the optimizer picks the join. For substrings, words are first resolved to the runs that contain them (a second
    reading of the text).
    """
    inside = measure is substring
    # Written first: the optimizer then knows its size, and never takes the texts, which grow when cut, for the smaller side.
    parts = materialize(literals_of(vocab, W.word_variants(F.col("word")) if measure is variant_count else F.array(F.lower("word"))), "words")
    found = text_runs(docs, key, keep, text, parts.agg(F.collect_set("k")).scalar(), edges=inside)
    if inside:
        parts = materialize(_resolved(parts, found.select("ticker", "k", "core", "joint").distinct()), "resolved")
    lead = F.endswith("before", "lead") if inside else F.col("before") == F.col("lead")
    trail = F.startswith("after", "trail") if inside else F.col("after") == F.col("trail")
    met = found.join(parts, ["ticker", "k", "core"]).where((F.col("lead").isNull() | lead) & (F.col("trail").isNull() | trail))
    if inside:
        return met.select("row", "ticker", "word", key, *keep, F.lit(1).alias("hits")).distinct().drop("row")
    places = met.groupBy("row", "ticker", "word", key, *keep).agg(
        F.array_sort(F.collect_list(F.struct("variant", "pos", "step", "n"))).alias("places"))
    hits = _hits("places") if measure is variant_count else F.lit(1)
    return places.select("ticker", "word", key, *keep, hits.alias("hits"))


def text_runs(docs: DataFrame, key: str, keep: tuple[str, ...], text: str, sizes: Column, edges: bool) -> DataFrame:
    """(row, ticker, key, keep..., k, core, joint, pos, before, after, n): what words are looked up in.

    One row per run of k tokens for every k of sizes, with the gaps around it (with edges also those at the ends of the
    text). As runs of no token: one row per gap that is not a single blank, one for all single blanks (n of them), and the
    empty run. joint is the first gap of a run with the characters on both sides.
    """
    lower = F.lower(text)
    cut = docs.where(F.col(text).isNotNull() & F.col("ticker").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "ticker", key, *keep, F.inline(F.array(F.struct(
            F.regexp_extract_all(lower, F.lit(TOKEN), F.lit(0)).alias("_tokens"), F.split(lower, TOKEN).alias("_gaps"), sizes.alias("_sizes")))))
    # Tokens and the gaps after them in turn.
    woven = F.flatten(F.zip_with("_tokens", F.slice("_gaps", 2, F.greatest(F.size("_tokens"), F.lit(1))), lambda t, g: F.array(t, g)))
    cut = cut.select("*", F.inline(F.array(F.struct(woven.alias("_woven")))))
    count, one, none, blank = F.size("_tokens"), F.lit(1), F.lit(None).cast("string"), F.lit(" ")

    def row(k: Column, core: Column, joint: Column, pos: Column, before: Column, after: Column, n: Column) -> Column:
        return F.struct(k.alias("k"), core.alias("core"), joint.alias("joint"), pos.alias("pos"), before.alias("before"),
                        after.alias("after"), n.alias("n"))

    def run(k: Column, i: Column) -> Column:
        before, after = F.get("_gaps", i), F.get("_gaps", i + k)
        # Elements are taken one by one: slice copies the whole array at every place.
        several = F.array_join(F.transform(F.sequence(2 * i, 2 * (i + k) - 2), lambda j: F.get("_woven", j)), "")
        core = F.when(k == 1, F.get("_tokens", i)).otherwise(several)
        sides = F.concat(F.right(F.get("_tokens", i), one), F.get("_gaps", i + 1), F.substring(F.get("_tokens", i + 1), 1, 1))
        return row(k, core, F.when(k > 1, sides) if edges else none, i, before if edges else F.when(i > 0, before),
                   after if edges else F.when(i + k < count, after), one)

    runs = F.flatten(F.transform(F.filter("_sizes", lambda k: (k > 0) & (k <= count)), lambda k: F.transform(
        F.sequence(F.lit(0), count - k), lambda i: run(k, i))))
    gaps = F.col("_gaps") if edges else F.when(count > 1, F.slice("_gaps", 2, F.greatest(count - 1, one))).otherwise(F.array().cast("array<string>"))
    zero = F.lit(0)
    other = F.filter(F.transform(gaps, lambda g, i: row(zero, g, none, i, none, none, one)), lambda g: ~g["core"].isin("", " "))
    blanks = F.array(row(zero, blank, none, F.lit(-1), none, none, F.size(F.filter(gaps, lambda g: g == blank))))
    empty = F.array(row(zero, F.lit(""), none, F.lit(-2), none, none, one if edges else F.least(count, one)))
    no_token = F.filter(F.concat(blanks, empty, other), lambda r: r["n"] > 0)
    nothing = F.filter(no_token, lambda r: F.lit(False))
    return cut.select("row", "ticker", key, *keep, F.inline(F.concat(runs, F.when(F.array_contains("_sizes", 0), no_token).otherwise(nothing))))


def literals_of(vocab: DataFrame, literals: Column) -> DataFrame:
    """(ticker, word, variant, k, step, core, joint, lead, trail): every literal as a run of k tokens between gaps.

    lead and trail are the gaps that the run must have before and after it, null where any will do. A hit may begin step
    tokens after the one before. A literal without a token is looked up among the gaps.
    """
    literal = vocab.select("ticker", "word", F.posexplode(literals).alias("variant", "literal")).select(
        "ticker", "word", "variant", "literal", F.inline(F.array(F.struct(
            F.regexp_extract_all("literal", F.lit(TOKEN), F.lit(0)).alias("_tokens"), F.split("literal", TOKEN).alias("_gaps")))))
    k, first, last = F.size("_tokens"), F.element_at("_gaps", 1), F.element_at("_gaps", -1)
    core = F.substring("literal", F.length(first) + 1, F.length("literal") - F.length(first) - F.length(last))
    joint = F.concat(F.right(F.get("_tokens", F.lit(0)), F.lit(1)), F.get("_gaps", F.lit(1)), F.substring(F.get("_tokens", F.lit(1)), 1, 1))
    return literal.select(
        "ticker", "word", "variant", k.alias("k"), (k + F.when((first != "") & (last != ""), 1).otherwise(0)).alias("step"),
        F.when(k > 0, core).otherwise(F.col("literal")).alias("core"), F.when(k > 1, joint).alias("joint"),
        F.when((k > 0) & (first != ""), first).alias("lead"), F.when((k > 0) & (last != ""), last).alias("trail"))


def _resolved(parts: DataFrame, seen: DataFrame) -> DataFrame:
    """parts with the runs seen in texts that their own run may lie in: its ends open where no gap is asked for.

    Runs of several tokens meet by their joint, single tokens and gaps by the first GRAM characters, at any place.
    """
    seen = seen.withColumnRenamed("core", "seen").withColumnRenamed("joint", "_joint")
    places = F.sequence(F.lit(1), F.greatest(F.length("seen"), F.lit(1)))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.transform(places, lambda p: F.substring(F.col("seen"), p, n))))
    seen = seen.select("ticker", "k", "seen", F.explode(F.when(F.col("k") > 1, F.array("_joint")).otherwise(F.array_distinct(grams))).alias("anchor"))
    fits = (F.when(F.col("core") == "", F.col("seen") == "")
            .when(F.col("lead").isNull() & F.col("trail").isNull(), F.contains("seen", "core"))
            .when(F.col("lead").isNull(), F.endswith("seen", "core"))
            .when(F.col("trail").isNull(), F.startswith("seen", "core"))
            .otherwise(F.col("seen") == F.col("core")))
    anchor = F.coalesce("joint", F.substring("core", 1, GRAM))
    met = parts.withColumn("anchor", anchor).join(seen, ["ticker", "k", "anchor"]).where(fits)
    return met.select("ticker", "word", "variant", "k", "step", F.col("seen").alias("core"), "lead", "trail")


def _hits(places: str) -> Column:
    """Hits of all variants from sorted (variant, pos, step, n), none overlapping the one before of its variant."""
    zero = F.struct(F.lit(-1).alias("variant"), F.lit(0).alias("free"), F.lit(0).alias("hits"))

    def add(at: Column, p: Column) -> Column:
        free = F.when(p["variant"] == at["variant"], at["free"]).otherwise(-2)
        counts = p["pos"] >= free
        return F.struct(p["variant"].alias("variant"), F.when(counts, p["pos"] + p["step"]).otherwise(free).alias("free"),
                        (at["hits"] + F.when(counts, p["n"]).otherwise(0)).alias("hits"))

    return F.aggregate(places, zero, add, lambda at: at["hits"])
