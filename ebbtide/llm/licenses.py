"""Licence scan: passages against templates by the Dice coefficient over word bigrams.

The main path is DataFrame functions only and needs no shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.license_texts import TEMPLATES
from ebbtide.llm.staging import id_back, id_or_least, only

PARAGRAPH = "\\n( *\\n)+"
SENTENCE = "[.!?]+[ \\t-\\r]+"
GAPS = (1, 4)  # one changed word leaves three places between known bigrams, two leave four


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def passages(plain: Column) -> Column:
    """Lines, paragraphs and the whole of a text of words, single spaces and line ends."""
    joined = F.transform(F.concat(F.split(plain, PARAGRAPH), F.array(plain)),
                         lambda p: F.regexp_replace(p, "[ \\n]+", " "))
    return F.transform(F.concat(F.split(plain, "\n"), joined), lambda p: F.trim(p))


def sentences(low: Column) -> Column:
    """Sentences of a text, over line ends, as words and single spaces."""
    return F.transform(F.split(low, SENTENCE),
                       lambda p: F.trim(F.regexp_replace(p, "[^\\p{L}\\p{N}]+", " ")))


def one_of(value: str, words: Sequence[str]) -> str:
    """An SQL condition that is one look-up in a hash table; words hold letters and digits."""
    return f"{value} IN ({', '.join(repr(w) for w in words)})"


def runs(gap: int, shortest: int) -> Column:
    """Words from the first to the last of known bigrams (known) at most gap places apart."""
    last = F.size("known") - 1
    starts = F.filter("known", lambda at, i: (i == 0) | (
        at - F.get("known", i - 1) > gap))
    ends = F.filter("known", lambda at, i: (i == last) | (
        F.get("known", i + 1) - at > gap))
    spans = F.filter(F.zip_with(starts, ends, lambda a, z: F.struct(
        a.alias("a"), (z - a + 1).alias("n"))), lambda r: r["n"] >= shortest)
    return F.transform(spans, lambda r: F.array_join(
        F.slice("words", r["a"] + 1, r["n"] + 1), " "))


def fewest(templates: Mapping[str, str], ratio: float) -> int:
    """Bigrams that a passage needs to match the shortest template."""
    return math.ceil(ratio * min((len(template_bigrams(t)) for t in templates.values()),
                                 default=1))


def literal(words) -> Column:
    """A constant array, as one expression however many words it has."""
    return F.split(F.lit("\n".join(words)), "\n")


def scan_licenses(docs: DataFrame, *, templates: Mapping[str, str] = TEMPLATES,
                  least: float = 0.8, inside: bool = False, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Per row of docs: key, n_passages, n_matches, license and dice.

    Passages are the distinct lines, paragraphs and the whole of a text; with inside also its
    sentences and the runs of word bigrams that occur in any template, at most GAPS places apart,
    so that a licence is found in the middle of a line or above code without a blank line.

    A passage matches a template if the Dice coefficient of their sets of word bigrams is at
    least least. Two bounds prune before that: a passage in which too many distinct words occur
    in no template cannot reach it, whatever its bigrams are, and neither can one with too many
    or too few bigrams for the template. n_matches counts pairs of a distinct passage and a
    template; license is the template with the highest coefficient, the first name of several,
    NULL without a match. Texts are compared whole, an empty or NULL one has no passage. Rows
    are kept as often as they come, NULL ids stay NULL, other columns are ignored, an empty
    table gives an empty result.
    """
    ratio = least / (2 - least) - 1e-9  # rounding must not prune what is exactly at least
    words = sorted({w for t in templates.values() for w in template_words(t)})
    entries = [(name, template_bigrams(t)) for name, t in sorted(templates.items())]
    pairs = sorted({b for _, bigrams in entries for b in bigrams})
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(b)).alias("n"),
                               literal(b).alias("bigrams")) for name, b in entries])
    texts = only(docs, doc=key, text=text).select(
        id_or_least("doc").alias("doc"),
        F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("low"))
    plain = texts.select("doc", "low", F.regexp_replace(
        "low", "[^\\p{L}\\p{N}\\n]+", " ").alias("plain"))
    found = plain.withColumn("words", F.split(F.trim(F.regexp_replace(
        "plain", "[ \n]+", " ")), " ")).withColumn("known", F.expr(
            f"filter(transform(words, (w, i) -> if({one_of('w', words)} AND "
            f"{one_of('concat(w, " ", get(words, i + 1))', pairs)}, i, -1)), i -> i >= 0)"))
    shortest = fewest(templates, ratio)
    cut = passages(F.col("plain"))
    if inside:
        cut = F.concat(cut, sentences(F.col("low")), *[runs(gap, shortest) for gap in GAPS])
    rows = found.select("doc", "known", F.filter(
        F.array_distinct(cut), lambda p: p != "").alias("passages"))
    worded = F.when(F.size("known") >= shortest, F.transform(
        "passages", lambda p: F.split(p, " "))).otherwise(
            F.array().cast("array<array<string>>")).alias("worded")
    # a word that no template has and that is not the last gives a bigram that none has
    strange = F.expr(f"""filter(worded, p -> size(array_distinct(filter(p, w -> NOT (
        {one_of('w', words)})))) - 1 <= {1 - ratio!r}D * (size(p) - 1))""")
    paired = F.transform(strange, lambda w: F.array_distinct(F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, i: F.concat(a, F.lit(" "), F.get(w, i + 1)))))
    near = rows.select("doc", "passages", worded).select("doc", "passages", F.filter(
        paired, lambda b: F.size(b) > 0).alias("near"), table.alias("table"))
    scored = F.flatten(F.transform("near", lambda b: F.transform(
        F.filter("table", lambda t: (F.size(b) >= ratio * t["n"]) & (
            F.size(b) * ratio <= t["n"])),
        lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(b, t["bigrams"])) / (F.size(b) + t["n"]))
            .alias("dice"), t["name"].alias("name")))))
    hits = near.select("doc", "passages", F.filter(
        scored, lambda s: s["dice"] >= least).alias("hits"))
    best = hits.withColumn("dice", F.array_max(F.transform("hits", lambda h: h["dice"])))
    return best.select(
        id_back(F.col("doc")).alias(key), F.size("passages").cast("long").alias("n_passages"),
        F.size("hits").cast("long").alias("n_matches"),
        F.array_min(F.transform(F.filter("hits", lambda h: h["dice"] == F.col("dice")),
                                lambda h: h["name"])).alias("license"), "dice")


def licenses_sql(templates: Mapping[str, str] = TEMPLATES, least: float = 0.8) -> str:
    """The same, inside texts too, as SQL over documents, without the bounds."""
    values = ", ".join(
        f"('{name}', [{', '.join(repr(b) for b in template_bigrams(t))}])"
        for name, t in sorted(templates.items()))
    shortest = fewest(templates, least / (2 - least) - 1e-9)
    return rf"""
        WITH templates(name, bigrams) AS (VALUES {values}),
        listed AS (SELECT name, len(bigrams) AS size, unnest(bigrams) AS bigram FROM templates),
        low AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS t
                FROM documents),
        plain AS (SELECT r, t, regexp_replace(t, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS p FROM low),
        cut AS (SELECT r, unnest(list_concat(list_concat(string_split(p, chr(10)), list_transform(
                    list_append(string_split_regex(p, '\n( *\n)+'), p),
                    lambda x: regexp_replace(x, '[ \n]+', ' ', 'g'))), list_transform(
                        string_split_regex(t, '[.!?]+[ \t-\r]+'),
                        lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}]+', ' ', 'g')))) AS part
                FROM plain),
        words AS (SELECT r, string_split(trim(regexp_replace(p, '[ \n]+', ' ', 'g')), ' ') AS w
                  FROM plain),
        places AS (SELECT r, unnest(range(1, len(w))) AS i, w FROM words),
        known AS (SELECT r, i FROM places WHERE w[i] || ' ' || w[i + 1] IN
                  (SELECT bigram FROM listed)),
        begun AS (SELECT r, i, gap, CASE WHEN i - lag(i) OVER (PARTITION BY r, gap ORDER BY i)
                      <= gap THEN 0 ELSE 1 END AS start
                  FROM known, (VALUES {', '.join(f'({gap})' for gap in GAPS)}) gaps(gap)),
        run AS (SELECT r, i, gap, sum(start) OVER (PARTITION BY r, gap ORDER BY i) AS number
                FROM begun),
        span AS (SELECT r, min(i) AS a, max(i) AS z FROM run GROUP BY r, gap, number
                 HAVING max(i) - min(i) + 1 >= {shortest}),
        each AS (SELECT row_number() OVER () AS id, r, part FROM (
                     SELECT r, trim(part) AS part FROM cut WHERE trim(part) <> ''
                     UNION SELECT r, array_to_string(w[a:z + 1], ' ')
                     FROM span JOIN words USING (r))),
        worded AS (SELECT id, r, string_split(part, ' ') AS w FROM each),
        paired AS (SELECT id, r, list_distinct(list_transform(range(1, len(w)),
                       lambda i: w[i] || ' ' || w[i + 1])) AS b FROM worded WHERE len(w) > 1),
        bigrams AS (SELECT id, r, len(b) AS size, unnest(b) AS bigram FROM paired),
        hits AS (SELECT b.id, any_value(b.r) AS r, name,
                     2.0 * count(*)::DOUBLE / (any_value(b.size) + any_value(l.size)) AS dice
                 FROM bigrams b JOIN listed l USING (bigram) GROUP BY b.id, name
                 HAVING 2.0 * count(*)::DOUBLE
                     / (any_value(b.size) + any_value(l.size)) >= {least}),
        counts AS (SELECT r, count(*) AS n_passages FROM each GROUP BY r),
        best AS (SELECT r, count(*) AS n, max(dice) AS dice FROM hits GROUP BY r),
        named AS (SELECT h.r, min(name) AS license FROM hits h JOIN best t
                  ON h.r = t.r AND h.dice = t.dice GROUP BY h.r)
        SELECT doc_id, coalesce(n_passages, 0)::BIGINT AS n_passages,
               coalesce(n, 0)::BIGINT AS n_matches, license, dice::DOUBLE AS dice
        FROM low LEFT JOIN counts USING (r) LEFT JOIN best USING (r) LEFT JOIN named USING (r)"""
