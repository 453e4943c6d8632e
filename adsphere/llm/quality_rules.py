"""Quality rules with distribution divergence (operator 3), DataFrame functions only.

Base rules count, per document, words, characters, symbols, repeated lines and words inside
repeated five-word windows.  The method then compares two histograms of the document with
its language's reference, which is taken from all documents of that language:

* character classes (lower case and other letters, upper case, digits, sentence marks,
  symbols, the rest), and
* common words (every word that makes up at least ``COMMON_SHARE`` of the language's words,
  and one bin for all others).

The distance is the Jensen-Shannon distance (base 2, so 0 to 1).  A document is rejected if
the class distance exceeds ``MAX_CLASS_JS``, or, with ``MIN_WORDS_FOR_WORDS`` words or more,
the word distance exceeds ``MAX_WORD_JS``.  Shorter documents are judged by classes only and
those under ``MIN_WORDS_FOR_CLASSES`` words not at all: a short text's histogram is noise.

Scale: two passes over the texts.  The first counts words per language with partial
aggregation; the reference that comes out has at most ``1/LANG_SHARE`` languages of
``1/COMMON_SHARE`` words each (shares of a total cannot number more), so it is broadcast.
The second works row by row on arrays inside the row; no document's words are shuffled.

Defined cases: a NULL or empty text has no words and fails the base rules; a NULL language,
or one with less than ``LANG_SHARE`` of all words, is compared with the reference of all
documents; repeated rows are each judged by themselves; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

LANG_SHARE = 0.01       # a language with a smaller share of all words has no reference of its own
COMMON_SHARE = 0.01     # a common word makes up at least this share of its language's words
MIN_WORDS_FOR_CLASSES = 10
MIN_WORDS_FOR_WORDS = 60
MAX_CLASS_JS = 0.30
MAX_WORD_JS = 0.30

ALL = "*"  # key of the reference over all documents
#: Character classes by pattern; lower case letters (and letters without case) are the rest.
CLASSES = (("upper", r"[A-Z]"), ("digit", r"[0-9]"), ("mark", r"""[.,;:!?'"()-]"""),
           ("symbol", r"[#*$%&|<>]"), ("other", r"[=+/\\@^_`~{}\[\]]"))
NO_CLASS = r"[^!-`{-~]+"


def _sql_text(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _class_counts(text: str, letters: str) -> str:
    """SQL array: the count of each class in ``text``, the rest of ``letters`` characters last.

    One scan drops what is in no class (lower case, white space, all beyond ASCII); the
    classes are then counted on the little that is left.
    """
    left = f"regexp_replace({text}, '{_sql_text(NO_CLASS)}', '')"
    each = [f"cast(length(regexp_replace(s, '{_sql_text('[^' + p[1:-1] + ']+')}', '')) as bigint)" for _, p in CLASSES]
    return (f"transform(array({left}), s -> transform(array(array({', '.join(each)})), c -> "
            f"concat(c, array(cast({letters} as bigint) - aggregate(c, 0L, (a, x) -> a + x))))[0])[0]")


def references(docs: DataFrame) -> DataFrame:
    """(lang, classes, common, shares): one row per language with a reference, and one for all."""
    counts = materialize(
        docs.select(F.coalesce("lang", F.lit(ALL)).alias("lang"), F.explode(words(F.col("text"))).alias("word"))
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    classes = F.expr(_class_counts("word", "length(word)"))
    n_classes = len(CLASSES) + 1
    sums = [F.sum(F.get("c", F.lit(i)) * F.col("n")).alias(f"c{i}") for i in range(n_classes)]
    per_lang = (counts.withColumn("c", classes)
                .groupBy("lang").agg(F.sum("n").alias("total"), *sums))
    everything = per_lang.groupBy().agg(F.sum("total").alias("total"),
                                        *[F.sum(f"c{i}").alias(f"c{i}") for i in range(n_classes)])
    # a language of its own needs LANG_SHARE of all words: at most 1/LANG_SHARE rows
    totals = materialize(
        per_lang.join(F.broadcast(everything.select(F.col("total").alias("grand"))))  # one row
        .where((F.col("lang") != ALL) & (F.col("total") >= LANG_SHARE * F.col("grand"))).drop("grand")
        .unionByName(everything.where(F.col("total") > 0).withColumn("lang", F.lit(ALL))).coalesce(1),
        "lang-totals")
    # every word of a kept language with COMMON_SHARE of its words: at most 1/COMMON_SHARE per language
    own = counts.where(F.col("lang") != ALL).join(F.broadcast(totals.select("lang", "total")), "lang")
    own = own.where(F.col("n") >= COMMON_SHARE * F.col("total"))
    grand = totals.where(F.col("lang") == ALL).select("total")
    joint = (counts.groupBy("word").agg(F.sum("n").alias("n")).join(F.broadcast(grand))
             .where(F.col("n") >= COMMON_SHARE * F.col("total")).withColumn("lang", F.lit(ALL)))
    common = (own.select("lang", "word", "n").unionByName(joint.select("lang", "word", "n"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w")))
    return totals.join(F.broadcast(common), "lang", "left").select(
        "lang", F.array(*[F.col(f"c{i}") for i in range(n_classes)]).alias("ref_classes"),
        F.expr("coalesce(transform(w, x -> x.word), cast(array() as array<string>))").alias("common"),
        F.expr("concat(coalesce(transform(w, x -> x.n), cast(array() as array<bigint>)), "
               "array(total - coalesce(aggregate(w, 0L, (a, x) -> a + x.n), 0L)))").alias("ref_words"))


def js_distance(p: str, q: str) -> str:
    """SQL: Jensen-Shannon distance (base 2) of two arrays of counts with the same bins."""
    term = ("if(x.p = 0, 0D, x.p * log2(2 * x.p / (x.p + x.q))) + "
            "if(x.q = 0, 0D, x.q * log2(2 * x.q / (x.p + x.q)))")
    total = "aggregate({0}, 0L, (a, x) -> a + x)"
    return f"""
      transform(array(named_struct('tp', {total.format(p)}, 'tq', {total.format(q)})), t ->
        if(t.tp = 0 or t.tq = 0, 0D, sqrt(greatest(0D, aggregate(
          zip_with({p}, {q}, (a, b) -> named_struct('p', a / cast(t.tp as double), 'q', b / cast(t.tq as double))),
          0D, (s, x) -> s + {term}) / 2))))[0]"""


def _repeat_words() -> str:
    """SQL: words of ``w`` inside five-word windows that occur twice or more in ``w``.

    Windows are 64-bit hashes of five word hashes.  Only documents in which some window
    repeats sort (hash, place) pairs; the places of repeated windows, in order, then cover
    ``least(5, distance to the next)`` words each.
    """
    n = WINDOW
    return f"""
      if(size(w) < {n + 1}, 0L,
        transform(array(transform(w, x -> xxhash64(x))), h ->
        transform(array(transform(sequence(0, size(h) - {n}),
                        i -> xxhash64({', '.join(f'h[i + {k}]' for k in range(n))}))), win ->
          if(size(array_distinct(win)) = size(win), 0L,
            transform(array(sort_array(transform(win, (x, i) -> named_struct('h', x, 'i', i)))), s ->
            transform(array(sort_array(transform(filter(s, (x, k) ->
                 (k > 0 and s[k - 1].h = x.h) or (k < size(s) - 1 and s[k + 1].h = x.h)), x -> x.i))), at ->
              aggregate(transform(at, (x, k) -> if(k = size(at) - 1, {n}, least({n}, at[k + 1] - x))),
                        0L, (a, x) -> a + x))[0])[0]))[0])[0])"""


def quality_features(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` plus the base counts, ``base_failed``, distances and ``kept``."""
    refs = references(docs.select("lang", "text"))
    default = refs.where(F.col("lang") == ALL).select(
        F.col("ref_classes").alias("d_classes"), F.col("common").alias("d_common"), F.col("ref_words").alias("d_words"))
    own = refs.where(F.col("lang") != ALL).select(
        F.col("lang").alias("_lang"), "ref_classes", "common", "ref_words")
    # both sides are bounded by the shares above
    d = (docs.join(F.broadcast(own), F.col("lang") == F.col("_lang"), "left")
         .join(F.broadcast(default), F.lit(True), "left"))
    d = (d.withColumn("_c", F.coalesce("ref_classes", "d_classes"))
         .withColumn("_v", F.coalesce("common", "d_common"))
         .withColumn("_r", F.coalesce("ref_words", "d_words")))
    t = "coalesce(text, '')"
    facts = F.expr(f"""
      transform(array(filter(split({t}, '{_sql_text(r"[ \x09-\x0D]+")}'), x -> x != '')), w ->
        named_struct(
          'n_words', cast(size(w) as bigint),
          'word_chars', cast(length(array_join(w, '')) as bigint),
          'n_repeat_words', {_repeat_words()},
          'hits', filter(w, x -> array_contains(_v, x))))[0]""")
    lines = F.expr(f"""
      transform(array(filter(split({t}, '\\n', -1), l -> l rlike '{_sql_text(r"[^ \x09-\x0D]")}')), l ->
        cast(size(l) - size(array_distinct(l)) as bigint))[0]""")
    d = d.withColumn("_f", facts).withColumn("n_dup_lines", lines)
    d = d.withColumn("_cc", F.expr(_class_counts(t, "_f.word_chars")))
    d = d.withColumn("_wc", F.expr(
        "transform(array(transform(_v, c -> cast(size(_f.hits) - size(array_remove(_f.hits, c)) as bigint))), "
        "k -> concat(k, array(_f.n_words - cast(size(_f.hits) as bigint))))[0]"))
    n, rep = F.col("_f.n_words"), F.col("_f.n_repeat_words")
    symbol = [name for name, _ in CLASSES].index("symbol")
    d = d.select(*docs.columns, n.alias("n_words"), F.col("_f.word_chars").alias("word_chars"),
                 F.get("_cc", F.lit(symbol)).alias("n_symbols"), "n_dup_lines", rep.alias("n_repeat_words"),
                 ((n < MIN_WORDS) | (100 * rep > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
                 F.expr(js_distance("_cc", "_c")).alias("class_js"),
                 F.expr(js_distance("_wc", "_r")).alias("word_js"))
    diverges = (((F.col("n_words") >= MIN_WORDS_FOR_CLASSES) & (F.col("class_js") > MAX_CLASS_JS))
                | ((F.col("n_words") >= MIN_WORDS_FOR_WORDS) & (F.col("word_js") > MAX_WORD_JS)))
    return d.withColumn("kept", ~F.col("base_failed") & ~diverges)


def quality_report(docs: DataFrame) -> DataFrame:
    """The base counts and the verdict of every document."""
    return quality_features(docs.select("doc_id", "lang", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_js", "word_js")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), "lang", "text")
    # the row number keeps the filter above the projection that computes the verdict once
    judged = quality_features(packed).withColumn("_row", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_row") >= 0)).select("_doc.*")
