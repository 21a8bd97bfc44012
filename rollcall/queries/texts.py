"""Names, slugs, addresses, tags and name similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import html as pages_html
from rollcall.functions.handles import candidate_handles
from rollcall.functions.phones import normalize_phones
from rollcall.functions.similarity import first_letter_block, names_match, sorted_tokens
from rollcall.functions.texts import escape_markdown, file_name, longest, slugify, street_of, transliterate, variant_label
from rollcall.operators.name_pairs import name_groups, same_name_edges, similar_name_pairs
from rollcall.queries import register
from rollcall.queries.base import BLANK_SQL, joined, listing_sql
from rollcall.settings import NAME_SIMILARITY, TAG_WORDS
from rollcall.sources.driver_tables import listings, table

TRANSLIT_SQL = (
    "translate(lower({0}), 'абвгдезийклмнопрстуфыэъь', 'abvgdeziyklmnoprstufye')"
)
for _letter, _latin in (("ё", "yo"), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ю", "yu"), ("я", "ya")):
    TRANSLIT_SQL = f"replace({TRANSLIT_SQL}, '{_letter}', '{_latin}')"


def slug_sql(value: str) -> str:
    latin = TRANSLIT_SQL.format(f"trim({value}, {BLANK_SQL})")
    return rf"trim(regexp_replace(regexp_replace({latin}, '[^a-z0-9\s\-]', '', 'g'), '\s+', '-', 'g'), '-')"


@register(
    "slugs",
    listing_sql(
        f"""
SELECT 'documents' AS kind, doc_id AS id, md5({slug_sql('text')}) AS slug FROM documents
UNION ALL SELECT 'listings', id, md5({slug_sql("address_raw || ' ' || name")}) FROM listings"""
    ),
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "text")
    named = listings(spark, folder).select(F.lit("listings").alias("kind"), "id", F.concat_ws(" ", "address_raw", "name").alias("text"))
    return documents.unionByName(named).select("kind", "id", F.md5(slugify(F.col("text"))).alias("slug"))


@register(
    "latin_addresses",
    listing_sql(f"SELECT id, {TRANSLIT_SQL.format('address_raw')} AS latin FROM listings"),
)
def _(spark, folder):
    return listings(spark, folder).select("id", transliterate(F.col("address_raw")).alias("latin"))


STREET_SQL = r"""
CASE WHEN regexp_extract(rest, '(?:ул\.?|улица|пр-т\.?|проспект|пер\.?|переулок)\s*(.+?)[,\d]') <> ''
     THEN trim(regexp_extract(rest, '(?:ул\.?|улица|пр-т\.?|проспект|пер\.?|переулок)\s*(.+?)[,\d]', 1))
     WHEN contains(rest, ',') THEN trim(split_part(rest, ',', 1)) ELSE rest END"""


@register(
    "streets",
    listing_sql(
        f"""
SELECT id, {STREET_SQL} AS street
FROM (SELECT id, CASE WHEN contains(a, 'г. ') THEN substr(a, instr(a, 'г. ') + 3)
                      WHEN contains(a, 'город ') THEN substr(a, instr(a, 'город ') + 6) ELSE a END AS rest
      FROM (SELECT id, lower(CASE id % 4 WHEN 0 THEN address_raw WHEN 1 THEN replace(address_raw, 'г. ', 'город ')
                             WHEN 2 THEN replace(address_raw, 'ул. ', 'проспект ') ELSE replace(address_raw, 'ул. ', '') END) AS a
            FROM listings))"""
    ),
)
def _(spark, folder):
    address, kind = F.col("address_raw"), F.col("id") % 4
    varied = (
        F.when(kind == 0, address)
        .when(kind == 1, F.replace(address, F.lit("г. "), F.lit("город ")))
        .when(kind == 2, F.replace(address, F.lit("ул. "), F.lit("проспект ")))
        .otherwise(F.replace(address, F.lit("ул. "), F.lit("")))
    )
    return listings(spark, folder).select("id", street_of(varied).alias("street"))


@register(
    "safe_names",
    rf"""
SELECT doc_id,
       CASE WHEN text = '' THEN 'unnamed' ELSE substr(trim(regexp_replace(regexp_replace(lower(trim(text, {BLANK_SQL})),
           '[^a-z0-9_\-]', '_', 'g'), '_+', '_', 'g'), '_'), 1, 100) END AS file_name,
       md5(regexp_replace(text, '([|\[\]()])', '\\\1', 'g')) AS escaped
FROM documents""",
)
def _(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", file_name(text).alias("file_name"), F.md5(escape_markdown(text)).alias("escaped")
    )


def _label_sql(letters: int) -> str:
    """Labels of one to ``letters`` letters, each length starting where the shorter ones end."""
    cases, start = [], 0
    for size in range(1, letters + 1):
        parts = [f"chr((65 + ((c_custkey - {start}) // {26**place}) % 26)::INTEGER)" for place in range(size - 1, -1, -1)]
        start += 26**size
        cases.append(f"WHEN c_custkey < {start} THEN {' || '.join(parts)}")
    return f"CASE {' '.join(cases)} END"


@register("variant_labels", f"SELECT c_custkey AS id, {_label_sql(8)} AS label FROM customer")
def _(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), variant_label(F.col("c_custkey")).alias("label"))


@register(
    "longest_values",
    """
SELECT p_partkey, CASE WHEN length(p_brand) > length(p_name) THEN
           (CASE WHEN length(p_type) > length(p_brand) THEN p_type ELSE p_brand END)
       ELSE (CASE WHEN length(p_type) > length(p_name) THEN p_type ELSE p_name END) END AS longest
FROM part""",
)
def _(spark, folder):
    return table(spark, folder, "part").select("p_partkey", longest(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("longest"))


@register(
    "name_blocks",
    r"""
SELECT block, count(DISTINCT text) AS names, count(*) AS rows_named, min(text) AS first_text
FROM (SELECT CASE WHEN regexp_matches(lower(p_name)[1], '^\p{L}') THEN lower(p_name)[1] ELSE '#' END AS block,
             array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS text FROM part)
GROUP BY block""",
)
def _(spark, folder):
    name = F.col("p_name")
    named = table(spark, folder, "part").select(first_letter_block(name).alias("block"), sorted_tokens(name).alias("text"))
    return named.groupBy("block").agg(
        F.countDistinct("text").alias("names"), F.count(F.lit(1)).alias("rows_named"), F.min("text").alias("first_text")
    )


# Longest common subsequence by rows: each row is the running maximum of (row, shifted row + match).
LCS_SQL = """list_reduce(
    list_prepend(list_transform(range(0, length({b}) + 1), lambda x: 0::BIGINT),
        list_transform(string_split({a}, ''), lambda c: list_prepend(0::BIGINT,
            list_transform(string_split({b}, ''), lambda d: CASE WHEN c = d THEN 1 ELSE 0 END::BIGINT)))),
    lambda r, m: list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1),
        lambda q: CASE WHEN q = 1 THEN 0 ELSE greatest(r[q], r[q - 1] + m[q]) END))))[-1]"""


def pair_sql(names: str, distance: str, threshold: int) -> str:
    """Pairs of different texts of a block whose distance is within the threshold."""
    return f"""
name AS ({names}),
pair AS (
    SELECT a.city, least(a.id, b.id) AS lo, greatest(a.id, b.id) AS hi,
           CASE WHEN a.id < b.id THEN a.text ELSE b.text END AS text_lo,
           CASE WHEN a.id < b.id THEN b.text ELSE a.text END AS text_hi
    FROM name a JOIN name b ON a.city = b.city AND a.block = b.block AND a.text < b.text
    WHERE levenshtein(a.text, b.text) * 100 <= {100 - threshold} * (length(a.text) + length(b.text))
),
measured AS (SELECT *, ({distance})::INTEGER AS distance FROM pair)
SELECT * FROM measured WHERE distance * 100 <= {100 - threshold} * (length(text_lo) + length(text_hi))"""


LISTING_NAMES = """
    SELECT city, lower(name)[1] AS block, array_to_string(list_sort(string_split(lower(name), ' ')), ' ') AS text, min(id) AS id
    FROM listings GROUP BY ALL"""
PART_NAMES = """
    SELECT 'all' AS city, lower(p_name)[1] AS block, array_to_string(list_sort(string_split(lower(p_name), ' ')), ' ') AS text,
           min(p_partkey) AS id FROM part GROUP BY ALL"""


@register(
    "similar_names",
    listing_sql(
        "",
        pair_sql(
            LISTING_NAMES,
            "length(text_lo) + length(text_hi) - 2 * " + LCS_SQL.format(a="text_lo", b="text_hi"),
            NAME_SIMILARITY,
        ),
    ),
)
def _(spark, folder):
    return similar_name_pairs(listings(spark, folder))


@register(
    "similar_name_groups",
    listing_sql(
        """
SELECT id, min(other) AS root FROM reach GROUP BY id""",
        pair_sql(
            LISTING_NAMES,
            "length(text_lo) + length(text_hi) - 2 * " + LCS_SQL.format(a="text_lo", b="text_hi"),
            NAME_SIMILARITY,
        ).replace("SELECT * FROM measured WHERE", ", alike AS (SELECT lo, hi FROM measured WHERE")
        + """),
own_name AS (SELECT l.id, n.id AS lowest FROM listings l JOIN name n ON n.city = l.city AND n.block = lower(l.name)[1]
             AND n.text = array_to_string(list_sort(string_split(lower(l.name), ' ')), ' ')),
edge AS (SELECT lo AS a, hi AS b FROM alike UNION SELECT hi, lo FROM alike UNION SELECT id, lowest FROM own_name UNION SELECT lowest, id FROM own_name),
reach AS (SELECT id, id AS other FROM own_name UNION SELECT r.id, e.b FROM reach r JOIN edge e ON r.other = e.a)""",
    ),
)
def _(spark, folder):
    return name_groups(listings(spark, folder))


@register(
    "similar_part_names",
    "WITH " + pair_sql(PART_NAMES, "length(text_lo) + length(text_hi) - 2 * " + LCS_SQL.format(a="text_lo", b="text_hi"), 75),
)
def _(spark, folder):
    named = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.lit("all").alias("city"), F.col("p_name").alias("name"))
    return similar_name_pairs(named, threshold=75)


@register(
    "matching_names",
    listing_sql(
        ", pair AS (SELECT city, id AS lo, id + 1 AS hi, lower(a.name) AS name_a, (SELECT lower(b.name) FROM listings b WHERE b.id = a.id + 1) AS name_b FROM listings a),"
        " word AS (SELECT *, array_to_string(list_sort(string_split(name_a, ' ')), ' ') AS text_a,"
        " array_to_string(list_sort(string_split(name_b, ' ')), ' ') AS text_b FROM pair WHERE name_b IS NOT NULL)"
        " SELECT lo, hi, (length(text_a) + length(text_b) - 2 * "
        + LCS_SQL.format(a="text_a", b="text_b")
        + f") * 100 <= {100 - NAME_SIMILARITY} * (length(text_a) + length(text_b)) AS alike FROM word"
    ),
)
def _(spark, folder):
    """Whether the names of neighbouring listings match."""
    rows = listings(spark, folder).select("id", "name")
    following = rows.select((F.col("id") - 1).alias("id"), F.col("name").alias("other"))
    return rows.join(following, "id").select(F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"), names_match(F.col("name"), F.col("other")).alias("alike"))


@register(
    "same_names",
    listing_sql(
        """
, name AS (SELECT city, id, lower(name)[1] AS block, array_to_string(list_sort(string_split(lower(name), ' ')), ' ') AS text FROM listings),
low AS (SELECT city, block, text, min(id) AS lo FROM name GROUP BY ALL)
SELECT id AS hi, lo FROM name JOIN low USING (city, block, text) WHERE id > lo"""
    ),
)
def _(spark, folder):
    return same_name_edges(listings(spark, folder))


@register(
    "candidate_handles",
    listing_sql(
        """
, named AS (SELECT l.id, regexp_replace(lower(name || ' ritualnye uslugi'), '[^a-z0-9]', '', 'g') AS b, min_by(phone, p.pos) AS phone
      FROM listings l LEFT JOIN phone p USING (id) GROUP BY ALL),
options AS (SELECT id, list_filter([substr(b, 1, 30), substr(replace(b, 'ritualnyeuslugi', 'ritual'), 1, 30),
      substr(b, 1, 20) || '_ritual', 'ritual_' || substr(b, 1, 20),
      CASE WHEN length(phone) >= 11 THEN substr(b, 1, 15) || right(phone, 4) END, CASE WHEN length(phone) >= 11 THEN phone END],
      lambda x: x IS NOT NULL AND length(x) >= 5) AS o FROM named)
SELECT id, array_to_string(list_filter(o, lambda x, i: list_position(o, x) = i), ';') AS handles FROM options"""
    ),
)
def _(spark, folder):
    phone = F.get(normalize_phones(F.col("phones")), 0)
    name = F.concat("name", F.lit(" ritualnye uslugi"))
    return listings(spark, folder).select("id", joined(candidate_handles(name, phone)).alias("handles"))


# Words that occur in the documents, as four tags.
LANGUAGE_TAGS = {"english": ("the", "and", "tion"), "french": ("eau", "que"), "german": ("sch", "und"), "spanish": ("ción", "para")}


def _tag_sql(tag: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"CASE WHEN contains(lower(text), '{w}') THEN '{w}' END" for w in words)
    return f"array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ';') AS {tag}"


@register(
    "keyword_tags",
    "SELECT doc_id, " + ", ".join(_tag_sql(tag, words) for tag, words in LANGUAGE_TAGS.items()) + " FROM documents",
)
def _(spark, folder):
    tags = [joined(pages_html.tag_words(F.col("text"), words)).alias(tag) for tag, words in LANGUAGE_TAGS.items()]
    return table(spark, folder, "documents").select("doc_id", *tags)


EVERY_WORD = [word for words in TAG_WORDS.values() for word in words]
_WORD_ROWS = ", ".join(f"({n}, '{tag}', '{word}')" for n, (tag, word) in enumerate((t, w) for t, words in TAG_WORDS.items() for w in words))


@register(
    "configured_tags",
    f"""
WITH words (n, tag, word) AS (VALUES {_WORD_ROWS}),
shown AS (SELECT doc_id, lower(text || ' ' || upper(word) || 'x') AS text FROM documents JOIN words ON doc_id % {len(EVERY_WORD) + 1} = n
          UNION ALL SELECT doc_id, lower(text) FROM documents WHERE doc_id % {len(EVERY_WORD) + 1} = {len(EVERY_WORD)})
SELECT doc_id, tag, string_agg(word, ';' ORDER BY n) AS words FROM shown JOIN words ON contains(text, lower(word)) GROUP BY ALL""",
)
def _(spark, folder):
    """The tags of the settings in documents of which all but one in so many name one of their words in capitals."""
    word = F.get(F.array(*map(F.lit, EVERY_WORD)), F.pmod("doc_id", F.lit(len(EVERY_WORD) + 1)).cast("int"))
    shown = F.concat("text", F.coalesce(F.concat(F.lit(" "), F.upper(word), F.lit("x")), F.lit("")))
    found = table(spark, folder, "documents").select("doc_id", F.explode(pages_html.words_by_tag(shown, TAG_WORDS)).alias("tag", "words"))
    return found.where(F.size("words") > 0).select("doc_id", "tag", joined(F.col("words")).alias("words"))
