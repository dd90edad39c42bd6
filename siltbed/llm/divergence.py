"""Quality rules of documents and their divergence from a language's profile, in DataFrame operations only.

Rules: too few words, and words in three-word windows that the text repeats. Divergence: the histogram of a document's
characters over classes (lower case, capitals, digits, blanks, symbols, other ASCII, all else) and that of its words over
the language's ``common`` most frequent words and all else are compared with the language's own by the Jensen-Shannon
distance (base 2, 0 to 1). A document fails where it is longer than a guard and farther than a bound; guards keep short
texts out, whose histograms say little.

A class is counted as what a pattern's removal takes off the text, each from what the last one left, so that only the
first works on the whole text; a common word as what its removal takes off the list of words. Repeated windows are those
that stand beside an equal one in the sorted list of "window, line feed, place" (no word holds a line feed), which is made of
windows that share a hash only. Nothing of a
document is shuffled; profiles are sums over all documents of a language.

Defined results: a null text has no words; a language without ``least_words`` words in all, or a null one, has no profile
and its documents are judged by the rules alone; ties among common words go to the smaller word by bytes; repeated rows
are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm._common import small, staged

BLANK = r"[\x20\x09-\x0D]+"
#: Patterns of the classes in the order in which they are taken off; what is left is the last class.
CLASSES = {"lower": "[a-z]+", "blank": BLANK, "capital": "[A-Z]+", "symbol": "[#*$%&|<>]+", "digit": "[0-9]+", "ascii": r"[\x00-\x7F]+"}
HISTOGRAM = [*CLASSES, "other"]


def with_classes(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``class_<name>``: how many characters of each class the column ``text`` holds."""
    out = docs.withColumn("left 0", F.col(text))
    for i, pattern in enumerate(CLASSES.values()):
        out = out.withColumn(f"left {i + 1}", F.regexp_replace(f"left {i}", pattern, ""))
    size = [F.char_length(f"left {i}").cast("long") for i in range(len(CLASSES) + 1)]
    counts = {f"class_{name}": size[i] - size[i + 1] for i, name in enumerate(CLASSES)} | {"class_other": size[-1]}
    return out.withColumns(counts).drop(*[f"left {i}" for i in range(len(CLASSES) + 1)])


def words_of(text: Column) -> Column:
    """Words of a text: anything but ASCII white space."""
    return F.array_remove(F.split(text, BLANK), "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return (F.size(full) - F.size(F.array_distinct(full))).cast("long")


def windows(words: str, places: str, width: int) -> Column:
    """"window, line feed, place" of the windows of so many words at ``places``."""
    parts = [f"{words}[cast(i + {k} as int)]" for k in range(width)]
    text = ", ' ', ".join(parts)
    return F.expr(f"transform({places}, i -> concat({text}, '\n', i))")


def with_repeated_words(docs: DataFrame, words: str, width: int = 3) -> DataFrame:
    """Adds ``n_repeat_words``: words that lie in a window found twice or more.

    A text whose windows all have hashes of their own repeats none. In the others 33 bits of each hash are sorted with the
    window's place behind them; windows beside an equal hash, and no others, may be repeated. Those are sorted as texts:
    places of repeated ones come in the order of their windows' bytes; sorted again, each covers the words up to the next
    place, at most ``width``.
    """
    parts = ", ".join(f"{words}[i + {k}]" for k in range(width))
    hashes = F.expr(f"transform(sequence(0, size({words}) - {width}), i -> xxhash64({parts}))")
    out = docs.withColumn("hashes", F.when(F.size(words) > width, hashes))
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    packed = F.expr("sort_array(transform(hashes, (h, i) -> (h & -2147483648L) | i))")
    out = out.withColumn("packed", F.when(twice, packed)).drop("hashes")
    beside = "zip_with(slice(packed, 1, size(packed) - 1), slice(packed, 2, size(packed) - 1), (a, b) -> if(shiftright(a, 31) = shiftright(b, 31), array(a, b), NULL))"
    beside = F.expr(f"transform(array_distinct(flatten(filter({beside}, x -> x IS NOT NULL))), x -> x & 2147483647L)")
    out = out.withColumn("beside", F.when(F.col("packed").isNotNull(), beside)).drop("packed")
    named = F.when(F.col("beside").isNotNull(), F.sort_array(windows(words, "beside", width)))
    out = out.withColumn("sorted", F.coalesce(named, F.array().cast("array<string>"))).drop("beside")
    out = out.withColumn("names", F.expr("transform(sorted, s -> substring_index(s, '\n', 1))"))
    twin = "(x, i) -> (i > 0 AND names[i] = names[greatest(i - 1, 0)]) OR (i + 1 < size(names) AND names[i] = names[least(i + 1, size(names) - 1)])"
    out = out.withColumn("places", F.expr(f"sort_array(transform(filter(sorted, {twin}), s -> cast(substring_index(s, '\n', -1) as long)))"))
    after = f"if(i + 1 < size(places), least({width}L, places[least(i + 1, size(places) - 1)] - p), {width}L)"
    covered = F.expr(f"aggregate(transform(places, (p, i) -> {after}), 0L, (a, b) -> a + b)")
    return out.withColumn("n_repeat_words", F.when(F.size("places") > 0, covered).otherwise(F.lit(0).cast("long"))).drop("sorted", "names", "places")


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.transform(counts, lambda c: c / total)


def jensen_shannon(p: str, q: str) -> Column:
    """Distance of two histograms, arrays of counts of equal length: the root of the mean relative entropy, base 2."""

    def entropy(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2.0 / (a + b))).otherwise(0.0)

    terms = F.zip_with(shares(F.col(p)), shares(F.col(q)), lambda a, b: (entropy(a, b) + entropy(b, a)) / 2.0)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)))


def class_counts() -> Column:
    return F.array(*[F.col(f"class_{name}").cast("double") for name in HISTOGRAM])


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = 32, least_words: int = 1000) -> DataFrame:
    """A row for each language of at least so many words: profile_lang, class_profile, common_words, word_profile.

    Over all documents. Counts are summed in each task before they are dealt out. Where a language has fewer words than
    ``common``, its list is shorter.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("profile_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    classes = with_classes(rows, "text").groupBy("profile_lang").agg(*[F.sum(f"class_{name}").alias(f"class_{name}") for name in HISTOGRAM])
    classes = classes.select("profile_lang", class_counts().alias("class_profile"))
    words = rows.select("profile_lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("profile_lang", "word").agg(F.count(F.lit(1)).alias("n"))
    words = staged(words, "rules-words")
    best = Window.partitionBy("profile_lang").orderBy(F.desc("n"), "word")
    top = words.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= common)
    top = top.groupBy("profile_lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    total = words.groupBy("profile_lang").agg(F.sum("n").alias("total")).where(F.col("total") >= least_words)
    rest = F.col("total") - F.expr("aggregate(top, 0L, (a, t) -> a + t.n)")
    found = top.join(total, "profile_lang").select(
        "profile_lang", F.col("top.word").alias("common_words"),
        F.concat(F.expr("transform(top, t -> cast(t.n as double))"), F.array(rest.cast("double"))).alias("word_profile"),
    )
    return staged(classes.join(found, "profile_lang"), "rules-profiles")


def word_counts(words: str, common: int) -> Column:
    """How often each of ``common_words`` is in the list of words, and all else."""
    found = [F.size(words) - F.size(F.array_remove(words, F.get("common_words", F.lit(i)))) for i in range(common)]
    found = F.array(*[F.coalesce(c, F.lit(0)).cast("double") for c in found])
    # One element, so that the counts are made once.
    held = F.array(F.slice(found, F.lit(1), F.size("common_words")))
    total = F.size(words).cast("double")
    return F.get(F.transform(held, lambda h: F.concat(h, F.array(total - F.aggregate(h, F.lit(0.0), lambda a, b: a + b)))), F.lit(0))


def judge(
    docs: DataFrame,
    known: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
    common: int = 32,
    class_guard: int = 200,
    word_guard: int = 100,
    class_bound: float = 0.3,
    word_bound: float = 0.35,
) -> DataFrame:
    """Columns ``keep``, counts, distances and verdicts for each row of ``docs``, by profiles that ``profiles`` gave.

    class_distance is null for texts of fewer than ``class_guard`` characters in words, word_distance for those of fewer
    than ``word_guard`` words, both where the language has no profile; a null distance fails nothing.
    """
    mine = docs.select(*[F.col(c).alias(f"kept {c}") for c in keep], F.col(lang_col).alias("own_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_classes(mine, "text").withColumn("words", words_of(F.col("text"))).withColumn("n_dup_lines", repeated_lines(F.col("text"))).drop("text")
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("word_chars", sum((F.col(f"class_{name}") for name in HISTOGRAM if name != "blank"), F.lit(0)).cast("long"))
    rows = with_repeated_words(rows, "words")
    rows = rows.join(small(known, 4096), F.col("own_lang") == F.col("profile_lang"), "left")
    known_lang = F.col("profile_lang").isNotNull()
    rows = rows.withColumn("own_classes", class_counts())
    rows = rows.withColumn("own_words", F.when(known_lang & (F.col("n_words") >= word_guard), word_counts("words", common))).drop("words")
    far = F.when(known_lang & (F.col("word_chars") >= class_guard), jensen_shannon("own_classes", "class_profile"))
    rows = rows.withColumn("class_distance", far).withColumn("word_distance", F.when(F.col("own_words").isNotNull(), jensen_shannon("own_words", "word_profile")))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    fits = F.coalesce(F.col("class_distance") <= class_bound, F.lit(True)) & F.coalesce(F.col("word_distance") <= word_bound, F.lit(True))
    # Always true, and not for the optimiser to move: a condition on the verdict, pushed down, would repeat every step above.
    fits &= F.monotonically_increasing_id() >= 0
    return rows.withColumn("base_failed", failed).select(
        *[F.col(f"kept {c}").alias(c) for c in keep], "n_words", "word_chars", F.col("class_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & fits).alias("kept"), F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )
