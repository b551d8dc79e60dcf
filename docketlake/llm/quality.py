"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words are compared with those of every language
reference by the Jensen-Shannon distance (the root of the divergence to base 2, from 0 to 1); the nearest reference counts.
References are the pooled histograms of all documents of a language that have enough words and few symbols; a language has one from its
first such document on, so no count of documents switches a rule. A test needs a least length: short texts have
ragged histograms. The base rules come first: too few words, or too many words in repeated three-word windows.

The features of every document are written once and read twice, for the references and for the verdicts. All references are one array of
a constant, so the plan does not grow with the languages.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.session import written

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Character classes in the order in which they are taken out of a text; what is left is the last class.
CLASSES = (("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("white", WHITE), ("digit", "[0-9]+"), ("letter", r"\p{L}+"), ("mark", "[.,;:!?'\"()-]+"))
#: Common words of the languages that references are kept for.
COMMON = tuple(
    sorted(
        set(
            "the of and to a in that is was for it with as be on by at this from are or an he not but had his they you we which have all their has were will would there been".split()
            + "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei einer um am sind noch wie einem".split()
            + "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son ou aux mais sa cette comme".split()
            + "de la que el en y a los del se las por un para con no una su al lo como más o pero sus le ha me si sin sobre este".split()
        )
    )
)


@dataclass(frozen=True)
class Rules:
    """min_words and max_repeat (percent of words) are the base rules. Short texts, of short_words or more, may lie max_class_short
    from the nearest reference by character classes; long ones, of long_words or more, max_class and max_common."""

    min_words: int = 50
    max_repeat: int = 50
    short_words: int = 50
    max_class_short: float = 0.30
    long_words: int = 150
    max_class: float = 0.19
    max_common: float = 0.35


def _with_words(docs: DataFrame) -> DataFrame:
    """Adds words and the counts that need the text; the text itself goes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("text", text).withColumn("words", F.filter(F.split("text", WHITE), lambda w: w != ""))
    out = out.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    out = out.withColumn("n_symbols", (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"))
    out = out.withColumn("n_words", F.size("words").cast("long")).withColumn("left", F.col("text"))
    for name, pattern in CLASSES:
        out = out.withColumn("rest", F.regexp_replace("left", pattern, ""))
        out = out.withColumn(f"c_{name}", (F.length("left") - F.length("rest")).cast("double")).withColumn("left", F.col("rest"))
    n_chars = sum((F.col(f"c_{name}") for name, _ in CLASSES), F.length("left").cast("double"))
    out = out.withColumn("word_chars", (n_chars - F.col("c_white")).cast("long"))
    out = out.withColumn("classes", F.array(*(F.col(f"c_{name}") for name, _ in CLASSES), F.length("left").cast("double")))
    return out.withColumn("common", F.sort_array(F.filter(F.transform("words", F.lower), lambda w: w.isin(*COMMON))))


def _repeated(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in three-word windows that occur twice or more. Windows are compared by 64-bit hash."""
    at = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("windows", F.transform(at, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(none))

    def same(i: Column, step: int) -> Column:
        return F.coalesce(F.get("placed", i).h == F.when(i + step >= 0, F.get("placed", i + step).h), F.lit(False))

    twice = F.filter(F.transform("placed", lambda x, i: F.when(same(i, -1) | same(i, 1), x.i)), lambda x: x.isNotNull())
    out = out.withColumn("starts", F.sort_array(twice))
    covers = F.transform("starts", lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get("starts", i - 1))))
    return out.withColumn("n_repeat_words", F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x))


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "common"]


def features(docs: DataFrame) -> DataFrame:
    """row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes (characters a class), common (sorted
    common words), for docs with row (anything to carry along) and text."""
    return _repeated(_with_words(docs)).select("row", *FEATURES)


REFERENCES = "array<struct<lang:string,classes:array<double>,common:array<double>,covered:double>>"


def references(told: DataFrame, rules: Rules) -> list[dict]:
    """Of features with lang, a row a language: lang, class shares, each common word's share of all words, and the sum of these.

    What comes to the driver is languages x (classes + common words) numbers.
    """
    # one pass: a pair (key, amount) for every common word and every other sum; the test stands inside, as a filter would be copied below
    sums = [("#words", F.col("n_words").cast("double")), *((f"#{k}", F.get("classes", F.lit(k))) for k in range(len(CLASSES) + 1))]
    pairs = F.concat(F.transform("common", lambda w: F.struct(w.alias("key"), F.lit(1.0).alias("x"))), F.array(*(F.struct(F.lit(k).alias("key"), x.alias("x")) for k, x in sums)))
    good = F.col("lang").isNotNull() & (F.col("n_words") >= rules.min_words) & (10 * F.col("n_symbols") <= F.col("n_words"))
    rows = told.select("lang", F.explode(F.when(good, pairs)).alias("pair")).groupBy("lang", F.col("pair.key").alias("key")).agg(F.sum("pair.x").alias("x")).collect()
    by_lang: dict[str, dict[str, float]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], {})[r["key"]] = r["x"]
    found = []
    for lang, got in sorted(by_lang.items()):
        classes = [got[f"#{k}"] for k in range(len(CLASSES) + 1)]
        if sum(classes):
            common = [got.get(w, 0.0) / got["#words"] for w in COMMON]
            found.append({"lang": lang, "classes": [c / sum(classes) for c in classes], "common": common, "covered": sum(common)})
    return found


def _part(p: Column, q: Column) -> Column:
    """One bin's part of the divergence, in bits."""
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) / 2 + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0) / 2


def _distances(df: DataFrame, found: list[dict]) -> DataFrame:
    """Adds class_distance and common_distance to the nearest reference; null where there is none or nothing to compare."""
    known = F.from_json(F.lit(json.dumps(found)), REFERENCES)  # a constant: worked out once, when the plan is made
    total, words = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x), F.when(F.col("n_words") > 0, F.col("n_words"))
    out = df.withColumn("total", total).withColumn("p", F.transform("classes", lambda x: x / F.when(F.col("total") > 0, F.col("total"))))
    near = F.transform(known, lambda r: F.aggregate(F.zip_with("p", r.classes, _part), F.lit(0.0), lambda a, x: a + x))
    out = out.withColumn("class_distance", F.sqrt(F.greatest(F.array_min(near), F.lit(0.0))))
    place = F.create_map(*(F.lit(x) for pair in zip(COMMON, range(len(COMMON)), strict=True) for x in pair))
    out = out.withColumn("distinct", F.array_distinct("common")).withColumn("first", F.transform("distinct", lambda w: F.array_position("common", w)))
    ends = F.transform("first", lambda x, i: F.coalesce(F.get("first", i + 1), F.size("common") + 1) - x)
    out = out.withColumn("bins", F.transform(ends, lambda n, i: F.struct(F.element_at(place, F.get("distinct", i)).alias("w"), (n / words).alias("p"))))
    out = out.withColumn("other", F.greatest(1.0 - F.size("common") / words, F.lit(0.0)))

    def away(r: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"))
        both = F.aggregate("bins", start, lambda a, b: F.struct((a.d + _part(b.p, F.get(r.common, b.w))).alias("d"), (a.q + F.get(r.common, b.w)).alias("q")))
        rest = F.greatest(r.covered - both.q, F.lit(0.0)) / 2  # common words that the document has not
        return both.d + rest + _part(F.col("other"), F.greatest(1.0 - r.covered, F.lit(0.0)))

    return out.withColumn("common_distance", F.sqrt(F.greatest(F.array_min(F.transform(known, away)), F.lit(0.0))))


def assess(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rules: Rules | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, common_distance.

    A null or empty text has no words and fails the base rules. Documents without a language are compared like all
    others but are in no reference. Where there is no reference at all, the base rules alone decide. Repeated rows give
    repeated rows, an empty table none; other columns are left out, whatever their names.
    """
    out = _judged(docs, F.col(id_col).alias("row"), text_col, lang_col, rules or Rules())
    return out.select(F.col("row").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "common_distance")


def keep_good(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names; rows travel whole, so there is no join.

    Null and empty texts go, as too short. Repeated rows are judged alike, so all or none stay. An empty table stays empty. A null language
    takes no part in references."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    out = _judged(docs, whole, text_col, lang_col, rules or Rules())
    # the verdict is made a column that the optimizer does not move: else the filter is copied into every step below it
    return out.select("row", F.when(F.spark_partition_id() >= 0, F.col("kept")).alias("kept")).where("kept").select("row.*")


def _judged(docs: DataFrame, row: Column, text_col: str, lang_col: str, rules: Rules) -> DataFrame:
    text, lang = F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    told = written(features(docs.select(F.struct(row.alias("row"), lang).alias("row"), text)).select("row.row", "row.lang", *FEATURES), "features")
    out = _distances(told, references(told, rules))
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat * F.col("n_words"))
    far = (F.col("class_distance") > rules.max_class) | (F.col("common_distance") > rules.max_common)
    odd = (F.col("n_words") >= rules.short_words) & (F.col("class_distance") > rules.max_class_short) | (F.col("n_words") >= rules.long_words) & far
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)))


def oracle_sql(rules: Rules | None = None) -> str:
    """The same rows in DuckDB SQL, for doc_id, the counts, base_failed and kept."""
    r = rules or Rules()
    common = ", ".join("'" + w + "'" for w in COMMON)
    names = [name for name, _ in CLASSES] + ["rest"]

    def part(p: str, q: str) -> str:
        one = "case when {x} > 0 then {x} * log2({x} / (({p} + {q}) / 2)) else 0 end / 2"
        return "(" + one.format(x=p, p=p, q=q) + " + " + one.format(x=q, p=p, q=q) + ")"

    return rf"""
with d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
c as (select doc_id, lang, words, len(words) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    length(t) as n_chars,
    length(regexp_replace(t, '[^a-z]+', '', 'g')) as c_lower,
    length(regexp_replace(t, '[^A-Z]+', '', 'g')) as c_upper,
    length(regexp_replace(t, '[^\x20\x09-\x0D]+', '', 'g')) as c_white,
    length(regexp_replace(t, '[^0-9]+', '', 'g')) as c_digit,
    length(regexp_replace(regexp_replace(t, '[a-zA-Z]+', '', 'g'), '[^\p{{L}}]+', '', 'g')) as c_letter,
    length(regexp_replace(t, '[^.,;:!?''\"()-]+', '', 'g')) as c_mark from w),
k as (select *, n_chars - c_lower - c_upper - c_white - c_digit - c_letter - c_mark as c_rest from c),
win as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from k)),
rep as (select doc_id, g from win group by doc_id, g having count(*) > 1),
cov as (select doc_id, count(distinct i + o.o) as n from win join rep using (doc_id, g), (values (0), (1), (2)) o(o) group by doc_id),
cw as (select doc_id, lower(x) as word from (select doc_id, unnest(words) as x from k) where lower(x) in ({common})),
dw as (select doc_id, word, count(*) as n from cw group by doc_id, word),
good as (select * from k where lang is not null and n_words >= {r.min_words} and 10 * n_symbols <= n_words),
ref as (select lang, sum(n_words) as words, {", ".join(f"sum(c_{n}) / sum(n_chars) as q_{n}" for n in names)} from good group by lang having sum(n_chars) > 0),
rw as (select g.lang, dw.word, sum(dw.n) / any_value(ref.words) as q from dw join good g using (doc_id) join ref on ref.lang = g.lang group by g.lang, dw.word),
covered as (select ref.lang, coalesce(sum(q), 0) as q from ref left join rw using (lang) group by ref.lang),
cd as (select doc_id, sqrt(greatest(min({" + ".join(part(f"(c_{n} / nullif(n_chars, 0))", f"q_{n}") for n in names)}), 0)) as x from k, ref group by doc_id),
told as (select k.doc_id, covered.lang, covered.q as covered, sum({part("(dw.n / nullif(k.n_words, 0))", "coalesce(rw.q, 0)")}) as d, sum(coalesce(rw.q, 0)) as q, sum(dw.n) / nullif(any_value(k.n_words), 0) as p
    from k cross join covered left join dw on dw.doc_id = k.doc_id left join rw on rw.lang = covered.lang and rw.word = dw.word group by k.doc_id, covered.lang, covered.q),
wd as (select doc_id, sqrt(greatest(min(coalesce(d, 0) + greatest(covered - q, 0) / 2 + {part("greatest(1 - coalesce(p, 0), 0)", "greatest(1 - covered, 0)")}), 0)) as x from told group by doc_id),
f as (select k.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(cov.n, 0) as n_repeat_words, cd.x as class_distance, wd.x as common_distance
    from k left join cov using (doc_id) left join cd using (doc_id) left join wd using (doc_id)),
b as (select *, n_words < {r.min_words} or 100 * n_repeat_words > {r.max_repeat} * n_words as base_failed from f)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
    cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
    not base_failed and not coalesce(n_words >= {r.short_words} and class_distance > {r.max_class_short} or n_words >= {r.long_words} and (class_distance > {r.max_class} or common_distance > {r.max_common}), false) as kept
from b"""
