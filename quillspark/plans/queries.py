"""Registered analyses: ``name -> fn(spark, base_dir) -> DataFrame``.

Every entry reads the driver tables (or tables Spark derives from them) in
full. Parameters (patterns, widths, k) are fixed per entry and repeated in
the matching SQL of ``quillspark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import catalog, cooccur, counts, dialogue, ordered, position
from quillspark.operators import relational as R
from quillspark.operators import sentiment, structure, weights
from quillspark.operators.ordered import dense
from quillspark.operators.tokens import remove_stopwords, unnest_tokens
from quillspark.plans import fixtures as FX
from quillspark.plans.inputs import conv_lines, doc_lines, doc_tokens, line_tokens, table
from quillspark.sources.text import text_lines

# Fixed parameters of the registered analyses (the oracle uses the same).
REGEX = "qu[ae]"
LITERAL = "tion."
ARC_WIDTH = 3
TOP_K = 10
GLOBAL_TOP_K = 20
MIN_N_TOP = 10
MIN_N_DECILE = 30
MIN_SHARE = 0.1
MARK_LEN = 60
BLANK_LEN = 20
SEGMENT_START = r"^\p{Lu}\p{Ll}*\.$"
SEGMENT_END = r" \| "
ACT_PATTERN = "^(The|Le|Die|El) "
SCENE_LITERAL = "ing."
SCENE_FIXES = {"tion": "TION"}
CONV_ORDER = [dense("turn"), "line_no"]
CONVS_ORDER = [dense("conv_id"), *CONV_ORDER]
REPLACE_PATTERN = "th[a-z]"
DROP_SPEAKERS = ("Akt", "Scene")
# Words that stand for authors in the catalogue selection.
AUTHOR_PATTERNS = ("^[a-e]", "e")
# ln() of the JVM and of C libraries may differ in the last bit; values
# built on it are reported rounded to this many decimals.
LN_DIGITS = 12
# Locale of the sorted analyses.
LOCALE = "de"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _stop(spark):
    """The stop list as local words: broadcast by its known size."""
    return FX.STOP_WORDS


def _docs(spark, base):
    return table(spark, base, "documents")


def _labels(spark, base):
    return table(spark, base, "labels")


def _brand_lines(spark, base):
    li = table(spark, base, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, base, "part").select("p_partkey", "p_brand")
    return R.join_on(li, part, {"l_partkey": "p_partkey"})


def _dialogue(spark, base):
    """Conversation lines with turn ids (role as speaker)."""
    return structure.number_turns(conv_lines(spark, base), ["conv_id"], CONV_ORDER,
                                  speaker="role")


# ---- sources ---------------------------------------------------------------

@register
def read_lines(spark, base):
    return doc_lines(spark, base).select("doc_id", "line_no", "line")


@register
def attach_meta(spark, base):
    """S6: meta data joined to the works, before they become lines."""
    meta = _labels(spark, base).select("doc_id", "quality")
    works = R.join_on(_docs(spark, base).select("doc_id", "text"), meta, ["doc_id"])
    return text_lines(works, "text").select("doc_id", "line_no", "quality")


# ---- projection and filter -------------------------------------------------

@register
def filter_regex(spark, base):
    return _docs(spark, base).where(T.str_detect("text", REGEX)).select("doc_id", "lang")


@register
def filter_not_regex(spark, base):
    return _docs(spark, base).where(~T.str_detect("text", REGEX)).select("doc_id", "lang")


@register
def filter_eq(spark, base):
    return _docs(spark, base).where(F.col("lang") == "de").select("doc_id", "source")


@register
def filter_range(spark, base):
    o = table(spark, base, "orders")
    return (o.where(F.col("o_totalprice") > 100000).where(F.col("o_totalprice") < 200000)
             .select("o_orderkey", "o_totalprice"))


@register
def having_count(spark, base):
    return counts.count_by(doc_tokens(spark, base), ["word"]).where(F.col("n") > 50)


@register
def filter_null(spark, base):
    d = R.join_on(_docs(spark, base).select("doc_id", "lang"),
                  _labels(spark, base).select("doc_id", "quality"), ["doc_id"], "left")
    return d.where(F.col("quality").isNull() & (F.col("lang") != "en")).select("doc_id", "lang")


@register
def project(spark, base):
    return _docs(spark, base).select("doc_id", "lang", "n_chars")


@register
def rename_cols(spark, base):
    return (_docs(spark, base).select("doc_id", "lang", "source")
            .withColumnRenamed("doc_id", "work_id").withColumnRenamed("lang", "language"))


@register
def if_else_null(spark, base):
    d = R.join_on(_docs(spark, base).select("doc_id", "lang"),
                  _labels(spark, base).select("doc_id", "quality"), ["doc_id"], "left")
    return d.select("doc_id", T.if_else(F.col("quality") == 1, "good", F.col("lang")).alias("flag"))


@register
def nth_level(spark, base):
    conv = table(spark, base, "conversations").select("conv_id", "turn", "role")
    return dialogue.nth_level(conv, "role", 2, [dense("turn")], part=["conv_id"])


# ---- joins -----------------------------------------------------------------

@register
def join_inner(spark, base):
    return R.join_on(_docs(spark, base).select("doc_id", "lang"),
                     _labels(spark, base).select("doc_id", "quality", "toxic"), ["doc_id"])


@register
def join_inner_mapped(spark, base):
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return R.join_on(o, c, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name", "c_mktsegment")


def _lang_counts(spark, base, lang, stop=None):
    t = doc_tokens(spark, base).where(F.col("lang") == lang)
    return counts.count_by(remove_stopwords(t, stop), ["word"])


@register
def join_natural(spark, base):
    en = _lang_counts(spark, base, "en").withColumnRenamed("n", "n_en")
    de = _lang_counts(spark, base, "de")
    return R.natural_join(en, de)


@register
def join_left(spark, base):
    return R.join_on(_docs(spark, base).select("doc_id"),
                     _labels(spark, base).select("doc_id", "quality", "toxic"), ["doc_id"], "left")


@register
def stopword_anti(spark, base):
    return remove_stopwords(doc_tokens(spark, base), _stop(spark)).select("doc_id", "tpos", "word")


@register
def category_minus(spark, base):
    en = _docs(spark, base).where(F.col("lang") == "en").select("doc_id")
    toxic = _labels(spark, base).where(F.col("toxic") == 1).select("doc_id")
    return R.anti(en, toxic, ["doc_id"])


@register
def semi_in(spark, base):
    o = table(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, base, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return R.semi_in(o, "o_custkey", c, "c_custkey")


# ---- aggregation -----------------------------------------------------------

@register
def count_by(spark, base):
    return counts.count_by(_docs(spark, base), ["lang"])


@register
def count_sorted(spark, base):
    return counts.count_by(doc_tokens(spark, base), ["word"], sort=True)


@register
def count_grouped(spark, base):
    return counts.count_by(doc_tokens(spark, base), ["source", "word"])


def _dec(c):
    return F.col(c).cast("decimal(12,2)")


@register
def weighted_mean(spark, base):
    li = table(spark, base, "lineitem")
    return li.groupBy("l_returnflag").agg(
        (F.sum(_dec("l_discount") * _dec("l_quantity")).cast("double")
         / F.sum(_dec("l_quantity")).cast("double")).alias("wmean"))


@register
def n_distinct_by(spark, base):
    ev = table(spark, base, "events")
    return ev.groupBy("event_type").agg(counts.n_distinct("user_id").alias("n"))


@register
def distinct_and_rows(spark, base):
    conv = table(spark, base, "conversations")
    return counts.distinct_and_rows(conv, ["role"], "conv_id")


@register
def share_of_total(spark, base):
    c = counts.count_by(remove_stopwords(doc_tokens(spark, base), _stop(spark)), ["word"])
    return counts.share_of_total(c.withColumn("share", F.col("n")), ["share"])


@register
def distinct_rows(spark, base):
    return table(spark, base, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@register
def drop_dupes(spark, base):
    return _docs(spark, base).select("text", "lang").dropDuplicates()


# ---- windows ---------------------------------------------------------------

@register
def line_number(spark, base):
    lines = doc_lines(spark, base).where(F.length("line") >= BLANK_LEN).select("doc_id", "line_no")
    return ordered.number_rows(lines, ["doc_id"], ["line_no"], "rn")


def _docs_text(spark, base):
    return table(spark, base, "documents").select("doc_id", "text")


@register
def row_number_all(spark, base):
    """N2: one running line number over all conversations."""
    lines = conv_lines(spark, base).select("conv_id", "turn", "line_no")
    return ordered.nested_row_number(lines, dense("conv_id"), CONV_ORDER, "rownumber")


@register
def rel_position(spark, base):
    t = position.text_positions(_docs_text(spark, base), stop_words=FX.STOP_WORDS)
    return t.select("doc_id", "tpos", "word_position")


def _decile_counts(spark, base):
    return position.text_decile_counts(_docs_text(spark, base), stop_words=FX.STOP_WORDS)


@register
def decile_counts(spark, base):
    return _decile_counts(spark, base)





@register
def lag_lead(spark, base):
    lines = conv_lines(spark, base).select("conv_id", "turn", "line_no", "line")
    return structure.add_neighbours(lines, ["conv_id"], CONV_ORDER).drop("line")


def _marked(spark, base):
    lines = conv_lines(spark, base).select("conv_id", "turn", "line_no", "line")
    return lines.select("conv_id", "turn", "line_no",
                        T.if_else_na(F.length("line") < MARK_LEN, F.col("line")).alias("mark"))


@register
def fill_down(spark, base):
    return ordered.ordered_scan(_marked(spark, base), ["conv_id"], CONV_ORDER, fill_down=["mark"])


@register
def fill_up(spark, base):
    return ordered.ordered_scan(_marked(spark, base), ["conv_id"], CONV_ORDER, fill_up=["mark"])


@register
def rank_marked(spark, base):
    m = _marked(spark, base)
    flag = F.col("mark").isNotNull().cast("int")
    d = ordered.ordered_scan(m, ["conv_id"], CONV_ORDER, running={"rk": (flag, True)})
    return d.select("conv_id", "turn", "line_no", T.if_else_na(F.col("mark").isNotNull(), F.col("rk")).alias("rk"))


# ---- sort and top-k --------------------------------------------------------

@register
def sort_multi(spark, base):
    o = table(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return R.arrange(o, "o_orderpriority", ("o_totalprice", "desc"), "o_orderkey")


@register
def topk_ties_group(spark, base):
    c = counts.count_by(doc_tokens(spark, base), ["lang", "word"])
    return weights.top_k_ties(c, ["lang"], TOP_K, "n")


@register
def topk_ties(spark, base):
    c = counts.count_by(remove_stopwords(doc_tokens(spark, base), _stop(spark)), ["word"])
    return weights.top_k_ties(c, [], GLOBAL_TOP_K, "n")


@register
def first_n(spark, base):
    sel = _docs(spark, base).where(F.col("lang") == "de").select("doc_id")
    return R.first_n(sel, "doc_id", 15)


# ---- set operations and reshape -------------------------------------------

def _parties(spark, base):
    c = table(spark, base, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    s = table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return c, s


@register
def union_by_name(spark, base):
    c, s = _parties(spark, base)
    return R.union_by_name(c, s)


@register
def union_labelled(spark, base):
    c, s = _parties(spark, base)
    return R.union_labelled({"customer": c.drop("mktsegment"), "supplier": s}, "kind")


@register
def pivot_fill(spark, base):
    o = table(spark, base, "orders")
    c = counts.count_by(o, ["o_orderpriority", "o_orderstatus"])
    return R.pivot_fill(c, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@register
def tokenize_count(spark, base):
    return counts.count_by(doc_tokens(spark, base), ["lang", "word"])


def _brand_pairs(spark, base):
    return cooccur.cooccurrence(_brand_lines(spark, base), ["l_orderkey"], "p_brand")


@register
def graph_vertices(spark, base):
    return cooccur.network_vertices(_brand_lines(spark, base), ["l_orderkey"], "p_brand")


# ---- scalar functions ------------------------------------------------------

@register
def contains_literal(spark, base):
    return _docs(spark, base).where(T.contains_fixed("text", LITERAL)).select("doc_id")


@register
def replace_first(spark, base):
    lines = doc_lines(spark, base)
    return lines.select("doc_id", "line_no", T.replace_first("line", REPLACE_PATTERN, "TH").alias("replaced"))


@register
def replace_all(spark, base):
    lines = doc_lines(spark, base)
    return lines.select("doc_id", "line_no", T.replace_all("line", REPLACE_PATTERN, "TH").alias("replaced"))


@register
def extract_regex(spark, base):
    pages = table(spark, base, "pages")
    return pages.select("page_id", T.str_extract("url", r"\?.*").alias("query"))


@register
def split_on_delim(spark, base):
    part = table(spark, base, "part")
    return part.select("p_partkey", T.before_delim("p_name", " ").alias("word"),
                       T.after_delim("p_name", " ").alias("kind"))


@register
def trim_ws(spark, base):
    docs = _docs(spark, base).select("doc_id", F.posexplode(F.split("text", r"\.", -1)).alias("k", "frag"))
    return docs.select("doc_id", (F.col("k") + 1).alias("k"), T.trim_ws("frag").alias("frag"))


@register
def concat_key(spark, base):
    n = table(spark, base, "nation")
    return n.select("n_name", T.paste("n_regionkey", "n_nationkey", sep=".").alias("key"))


@register
def bucket_lines(spark, base):
    lines = doc_lines(spark, base)
    return counts.count_by(lines.withColumn("idx", T.floor_div("line_no", ARC_WIDTH)), ["doc_id", "idx"])


@register
def signed_counts(spark, base):
    c = counts.count_by(table(spark, base, "lineitem"), ["l_returnflag", "l_linestatus"])
    return c.withColumn("n", T.if_else(F.col("l_linestatus") == "F", -F.col("n"), F.col("n")))


@register
def level_code(spark, base):
    conv = table(spark, base, "conversations").select("conv_id", "turn", "role")
    return ordered.first_seen_code(conv, ["conv_id"], ["turn"], "role", "code")


@register
def alpha_code(spark, base):
    """codes of the distinct words in sorted (byte) order."""
    return ordered.alphabetical_code(doc_tokens(spark, base), "word", "code")


@register
def alpha_code_locale(spark, base):
    """F17 in a locale's order: accents and case as R's default levels have them."""
    return ordered.alphabetical_code(doc_tokens(spark, base), "word", "code", collation=LOCALE)


@register
def sort_locale(spark, base):
    """O1 in a locale's order: capitalised and accented first words of the documents."""
    d = _docs(spark, base).select("doc_id", "lang", T.first_word("text").alias("first"))
    return R.arrange(d, "first", ("lang", "desc"), "doc_id", collation=LOCALE)


@register
def reorder_by_mean(spark, base):
    return weights.mean_order(table(spark, base, "part"), "p_brand", _dec("p_retailprice"))


# ---- composite analyses ----------------------------------------------------

@register
def word_counts(spark, base):
    return counts.word_counts(doc_tokens(spark, base), ["lang"], _stop(spark))


@register
def compare_vocab(spark, base):
    return counts.compare_groups(doc_tokens(spark, base), "lang", "en", "de", "share_en", "share_de",
                                 stop=_stop(spark))


def _lang_word_counts(spark, base):
    return counts.word_counts(doc_tokens(spark, base), ["lang"], _stop(spark), sort=False)


def _ln_rounded(df, cols=("idf", "tf_idf")):
    return df.withColumns({c: F.round(c, LN_DIGITS) for c in cols if c in df.columns})


@register
def tf_idf(spark, base):
    return _ln_rounded(weights.tf_idf(_lang_word_counts(spark, base), "word", "lang"))


@register
def sentiment_arc(spark, base):
    return sentiment.sentiment_arc(line_tokens(spark, base), FX.polarity_rows(), ["doc_id"], "line_no",
                                   width=ARC_WIDTH, stop=_stop(spark))


@register
def sentiment_signed(spark, base):
    return sentiment.sentiment_signed(line_tokens(spark, base), FX.polarity_rows(), ["doc_id"], "line_no",
                                      width=ARC_WIDTH, stop=_stop(spark))


@register
def sentiment_decile(spark, base):
    return position.decile_scores(_decile_counts(spark, base), list(FX.SCORES.items()))


@register
def top_terms(spark, base):
    c = counts.word_counts(doc_tokens(spark, base), ["source"], _stop(spark), sort=False)
    w = weights.tf_idf(c, "word", "source")
    return _ln_rounded(weights.top_terms(w, ["source"], TOP_K, min_n=MIN_N_TOP).select("source", "word", "n", "tf_idf"))


@register
def tfidf_decile(spark, base):
    out = position.decile_top_terms(_decile_counts(spark, base), min_n=MIN_N_DECILE, k=TOP_K)
    return _ln_rounded(out.select("decile", "word", "n", "tf_idf"))


def _catalogue(spark, base):
    docs = _docs(spark, base)
    labels = _labels(spark, base).select("doc_id", (F.col("quality") == 1).alias("has_text"), "toxic")
    meta = docs.select("doc_id", F.col("lang").alias("language")).join(labels, "doc_id")
    subjects = docs.select("doc_id", F.col("source").alias("subject"))
    return meta, subjects


@register
def select_works(spark, base):
    meta, subjects = _catalogue(spark, base)
    sub = catalog.select_works(meta.where(F.col("toxic") == 1), subjects, id_col="doc_id",
                               subject_pattern="^src1", language="en")
    sel = catalog.select_works(meta, subjects, id_col="doc_id", subject_pattern="^src1",
                               language="en", minus=sub)
    return sel.select("doc_id", "subject")


@register
def subject_counts(spark, base):
    meta, subjects = _catalogue(spark, base)
    return catalog.subject_counts(subjects, meta, id_col="doc_id", has_text_col="has_text")


@register
def subject_counts_period(spark, base):
    """Q10, period form: works (orders) of authors (customers) "born"
    (nation key) strictly between 5 and 15, by subject (order priority)."""
    orders = table(spark, base, "orders").select(F.col("o_orderkey").alias("work_id"), "o_custkey",
                                                 F.col("o_orderpriority").alias("subject"))
    cust = table(spark, base, "customer").select("c_custkey", F.col("c_name").alias("author"),
                                                 F.col("c_nationkey").alias("birthdate"))
    meta = R.join_on(orders.select("work_id", "o_custkey"), cust.select("c_custkey", "author"),
                     {"o_custkey": "c_custkey"})
    return catalog.subject_counts(orders.select("work_id", "subject"), meta, id_col="work_id",
                                  authors=cust.select("author", "birthdate"), born=(5, 15))


@register
def cooccurrence(spark, base):
    return _brand_pairs(spark, base)


@register
def cooccurrence_share(spark, base):
    return cooccur.cooccurrence_share(_brand_lines(spark, base), ["l_orderkey"], "p_brand",
                                      min_share=MIN_SHARE)


def _doc_lines_nb(spark, base):
    return doc_lines(spark, base, neighbours=structure.NEIGHBOURS)


@register
def segment_trim(spark, base):
    lines = _doc_lines_nb(spark, base)
    seg = structure.mark_segments(lines, ["doc_id"], ["line_no"],
                                  start=F.col("prev1").rlike(SEGMENT_START),
                                  end=F.col("line").rlike(SEGMENT_END))
    return seg.select("doc_id", "line_no", "is_book")


@register
def front_matter(spark, base):
    lines = _doc_lines_nb(spark, base)
    front, _ = structure.split_front_matter(lines, ["doc_id"], ["line_no"],
                                            body_start=F.length("next1") < BLANK_LEN)
    return front.select("doc_id", "line_no", "line")


@register
def annotate_structure(spark, base):
    lines = _doc_lines_nb(spark, base)
    d = structure.annotate_structure(lines, ["doc_id"], ["line_no"], act_pattern=ACT_PATTERN,
                                     scene_literal=SCENE_LITERAL, scene_fixes=SCENE_FIXES,
                                     is_blank=lambda c: F.length(c) < BLANK_LEN)
    return d.select("doc_id", "line_no", "akt", "scene", "speaker", "scene_description")


@register
def play_network(spark, base):
    """The play pipeline end to end: structure marks, speaker clean-up, and
    the network of speakers sharing a scene (documents as plays)."""
    lines = _doc_lines_nb(spark, base)
    d = structure.annotate_structure(lines, ["doc_id"], ["line_no"], act_pattern=ACT_PATTERN,
                                     scene_literal=SCENE_LITERAL, scene_fixes=SCENE_FIXES,
                                     is_blank=lambda c: F.length(c) < BLANK_LEN)
    d = structure.clean_speakers(d, None, drop_patterns=DROP_SPEAKERS)
    return cooccur.cooccurrence(d, ["doc_id", "akt", "scene"], "speaker_clean")


@register
def clean_speakers(spark, base):
    lines = conv_lines(spark, base).withColumn("speaker", F.col("role"))
    d = structure.clean_speakers(lines, FX.cast_table(spark), aliases=FX.SPEAKER_ALIASES,
                                 drop_patterns=DROP_SPEAKERS)
    return d.select("conv_id", "turn", "line_no", "speaker_clean", "activity", "nameshort", "gender")


@register
def name_profile(spark, base):
    authors = table(spark, base, "part").select(F.col("p_name").alias("author"),
                                                F.col("p_size").alias("birthdate"))
    return catalog.name_profile(authors, FX.first_names(spark), born=(10, 40), years=FX.NAME_YEARS)


@register
def number_turns(spark, base):
    return _dialogue(spark, base).select("conv_id", "turn", "line_no", "rownumber", "turnswitch", "dialrank")


@register
def turns_per_role(spark, base):
    d = _dialogue(spark, base).withColumn("turn_key", T.paste("conv_id", "dialrank"))
    return dialogue.turns_per(d, ["role"], "turn_key")


@register
def roles_per_conv(spark, base):
    return dialogue.participants_per(_dialogue(spark, base), ["conv_id"], "role")


@register
def lines_per_role(spark, base):
    return dialogue.lines_per(_dialogue(spark, base), ["conv_id", "role"])


@register
def scene_sizes(spark, base):
    """Q23: turns and lines per scene and cast member, cast members with a
    known gender only."""
    cast = FX.cast_table(spark).select("speaker_clean", "nameshort", "gender")
    d = R.join_on(_dialogue(spark, base), cast, {"role": "speaker_clean"}, "left")
    return (dialogue.lines_per(d, ["conv_id", "nameshort", "gender"]).where(F.col("gender").isNotNull())
            .orderBy("conv_id", "nameshort"))


@register
def words_per_role(spark, base):
    lines = conv_lines(spark, base)
    return dialogue.words_per(lines, ["conv_id", "role"], levels={"conv_id": "scene_code", "role": "role_code"},
                              order=CONVS_ORDER)


def _raw_lexicon(spark, base):
    part = table(spark, base, "part").select(
        F.regexp_replace("p_name", " ", "|").alias("Wort_POS"), F.col("p_retailprice").alias("Wert"),
        F.concat_ws(",", F.lower("p_type"), F.lower("p_brand")).alias("Inflektionen"), "p_size")
    neg = part.where(F.col("p_size") < 25).drop("p_size")
    pos = part.where(F.col("p_size") >= 25).drop("p_size")
    return neg, pos


@register
def build_lexicon(spark, base):
    neg, pos = _raw_lexicon(spark, base)
    return sentiment.build_lexicon(neg, pos)


@register
def sentiment_by_conv(spark, base):
    tokens = unnest_tokens(conv_lines(spark, base), "line", "word")
    lex = FX.polarity_rows("neg", "pos")
    return sentiment.sentiment_by(tokens, lex, ["conv_id"], stop=_stop(spark))


@register
def sentiment_by_conv_ordered(spark, base):
    """Q21, second form: scene sentiment listed in order of appearance."""
    lines = conv_lines(spark, base)
    codes = ordered.first_seen_code(lines, [], CONVS_ORDER, "conv_id", "scene_code")
    out = R.join_on(sentiment_by_conv(spark, base), codes, ["conv_id"], "left")
    return R.arrange(out, "scene_code")


@register
def scene_at(spark, base):
    lines = conv_lines(spark, base).select("conv_id", "turn", "line_no", "line")
    return dialogue.nth_level(lines, "conv_id", 5, CONVS_ORDER)


# ---- general paths: tables as stop lists, works of many rows, two levels -----

@register
def stop_table_counts(spark, base):
    """J6 against a stop *table*: words that no benchmark item holds."""
    stop = unnest_tokens(table(spark, base, "benchmark").select("text"), "text", "word", position=None).distinct()
    return counts.count_by(remove_stopwords(doc_tokens(spark, base), stop), ["lang", "word"])


WORK_ORDER = [*CONV_ORDER, "tpos"]


def _work_tokens(spark, base):
    """Tokens of works that are many rows: conversations, line by line."""
    lines = conv_lines(spark, base).select("conv_id", "turn", "line_no", "line")
    return unnest_tokens(lines, "line", "word", position="tpos")


@register
def rel_position_works(spark, base):
    t = remove_stopwords(_work_tokens(spark, base), FX.stop_words(spark))
    return position.relative_position(t, ["conv_id"], WORK_ORDER)


@register
def sentiment_decile_works(spark, base):
    return position.sentiment_by_decile(_work_tokens(spark, base), FX.scores(spark), ["conv_id"], WORK_ORDER,
                                        FX.stop_words(spark))


@register
def tfidf_decile_works(spark, base):
    out = position.top_terms_by_decile(_work_tokens(spark, base), ["conv_id"], WORK_ORDER, FX.stop_words(spark),
                                       min_n=MIN_N_DECILE, k=TOP_K)
    return _ln_rounded(out.select("decile", "word", "n", "tf_idf"))


@register
def compare_tables(spark, base):
    """Q2 on two tables: words of conversations against words of benchmark items."""
    one = counts.word_counts(_work_tokens(spark, base).select("word"), stop=_stop(spark), sort=False)
    items = unnest_tokens(table(spark, base, "benchmark").select("text"), "text", "word", position=None)
    two = counts.word_counts(items, stop=_stop(spark), sort=False)
    return counts.compare_vocab(one, two, "share_conv", "share_items")


@register
def select_works_author(spark, base):
    """Q9 with author predicates: parts as works, their names as authors."""
    meta = table(spark, base, "part").select(F.col("p_partkey").alias("work_id"), F.col("p_name").alias("author"),
                                             (F.col("p_size") > 10).alias("has_text"))
    return catalog.select_works(meta, author_patterns=AUTHOR_PATTERNS).select("work_id", "author")


@register
def body_lines(spark, base):
    """Q13, the half after the front matter."""
    _, body = structure.split_front_matter(_doc_lines_nb(spark, base), ["doc_id"], ["line_no"],
                                           body_start=F.length("next1") < BLANK_LEN)
    return body.select("doc_id", "line_no", "line")


def _annotated(spark, base):
    lines = _doc_lines_nb(spark, base)
    return structure.annotate_structure(lines, ["doc_id"], ["line_no"], act_pattern=ACT_PATTERN,
                                        scene_literal=SCENE_LITERAL, scene_fixes=SCENE_FIXES,
                                        is_blank=lambda c: F.length(c) < BLANK_LEN)


@register
def scene_pick(spark, base):
    """Q22 on two levels: the second act and the second scene of every play."""
    d = _annotated(spark, base).select("doc_id", "line_no", "line", "akt", "scene")
    return dialogue.scene_at(d, 2, 2, ["line_no"], part=["doc_id"])


@register
def words_per_scene(spark, base):
    """Q19 by act and scene, labelled with both codes by first appearance."""
    return dialogue.words_per(_annotated(spark, base), ["akt", "scene"], levels={"akt": "act_code", "scene": "scene_code"},
                              order=["doc_id", "line_no"])


@register
def speakers_per_scene(spark, base):
    return dialogue.participants_per(_annotated(spark, base), ["doc_id", "akt", "scene"], "speaker")


@register
def lines_per_scene(spark, base):
    """Q18 by act and scene: turns and lines of each speaker."""
    d = _annotated(spark, base).select("doc_id", "line_no", "akt", "scene", "speaker")
    d = structure.number_turns(d, ["doc_id"], ["line_no"], speaker="speaker")
    return dialogue.lines_per(d, ["doc_id", "akt", "scene", "speaker"])


@register
def first_seen_source(spark, base):
    """F15 where first appearance and sorted order differ."""
    return ordered.first_seen_code(_docs(spark, base).select("doc_id", "source"), [], ["doc_id"], "source")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


__all__ = ["REGISTRY", "queries"]
