"""Markup, templates and sections: wikitext is made of columns so that SQL knows the plain text without a parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.operators.extract import raw_to_plain_text
from spindrift.operators.sections import section_tree, sections
from spindrift.plans.catalog import query
from spindrift.plans.graph_queries import spread


def _text_query(name: str, source: str, key: str, wikitext: str, expected: str) -> None:
    """Registers the plain text of a wikitext that both engines can write as an expression."""

    @query(name, f"SELECT {key}, {expected} AS plain FROM {source}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = spread(spark, sf_dir, source).select(key, F.expr(wikitext).alias("wikitext"))
        return made.select(key, raw_to_plain_text("wikitext").alias("plain"))


_NL = "chr(10)"

# name, wikitext, plain text: over customer (c_name, c_custkey, c_nationkey, c_mktsegment)
MARKUP = [
    ("links", "'see [[' || c_name || '|the ' || c_mktsegment || ' one]] and [[' || c_name || ']] [[File:a.png|thumb|of [[' || c_name || ']]]]x[[Category:y]]'", "'see the ' || c_mktsegment || ' one and ' || c_name || ' x'"),
    ("quotes", "'''''''' || c_name || ''''''' is ''''' || c_mktsegment || ''''' or ''''''''''' || c_custkey || ''''''''''' and '''' open'", "c_name || ' is ' || c_mktsegment || ' or ' || c_custkey || ' and '''' open'"),
    ("comments", "'a' || c_custkey || '<!-- ' || c_name || ' -->b <!-- never ' || c_name", "'a' || c_custkey || 'b <!-- never ' || c_name"),
    ("references", "c_name || '<ref name=x/> is<ref>' || c_custkey || '</ref> here<nowiki>' || c_name || '</nowiki>'", "c_name || ' is here'"),
    ("kept_elements", "'H<sub>' || c_custkey || '</sub>O <small>a [[x|' || c_name || ']]</small> <span class=\"q\">' || c_mktsegment || '</span>'", "'H' || c_custkey || 'O a ' || c_name || ' ' || c_mktsegment"),
    ("dropped_elements", "c_name || '<math>x^' || c_custkey || '</math> and <gallery>' || c_name || '</gallery>end'", "c_name || ' and end'"),
    ("bare_tags", "'<div class=\"x\">' || c_name || '<br />' || c_custkey || '</div><section begin=a />z'", "c_name || c_custkey || 'z'"),
    ("lists", f"'intro' || {_NL} || '*' || c_name || {_NL} || '##' || c_custkey || {_NL} || 'end'", f"'intro' || {_NL} || c_name || {_NL} || c_custkey || {_NL} || 'end'"),
    ("tables", f"'before' || {_NL} || '{{| class=w' || {_NL} || '|-' || {_NL} || '| ' || c_name || {_NL} || '|}}' || {_NL} || 'after ' || c_custkey", f"'before' || {_NL} || 'after ' || c_custkey"),
    ("table_templates", f"'a ' || c_custkey || {_NL} || '{{{{col-begin}}}}' || c_name || {_NL} || '== H' || c_custkey || ' ==' || {_NL} || 'z' || {_NL} || '{{{{refbegin}}}}' || c_name || '{{{{refend}}}}q{{{{box}}}}' || c_custkey || '{{{{end}}}}r'", f"'a ' || c_custkey || {_NL} || '== H' || c_custkey || ' ==' || {_NL} || 'z' || {_NL} || 'qr'"),
    ("squads", "'{{fs start}}{{fs player|no=' || c_custkey || '|name=' || c_name || '}}{{fs end}}kept ' || c_custkey", "'kept ' || c_custkey"),
    ("dropped_sections", f"c_name || {_NL} || '== See also ==' || {_NL} || '* ' || c_name || {_NL} || '== Kept ' || c_custkey || ' ==' || {_NL} || 'text' || {_NL} || '==References==' || {_NL} || 'x'", f"c_name || {_NL} || '== Kept ' || c_custkey || ' ==' || {_NL} || 'text'"),
    ("remnant_lines", f"c_name || {_NL} || '| left ' || c_custkey || {_NL} || {_NL} || '! head' || {_NL} || c_mktsegment", f"c_name || {_NL} || c_mktsegment"),
    ("parentheses_spaces", "c_name || ' (…; –) is   ' || c_custkey || ' (a)'", "c_name || ' is ' || c_custkey || ' (a)'"),
    ("entities", "c_name || ' &amp; &lt;' || c_custkey || '&gt; x&nbsp;y&minus;z'", "c_name || ' & <' || c_custkey || '> x' || chr(160) || 'y' || chr(8722) || 'z'"),
    ("nested_templates", "'{{nowrap|' || c_name || ' {{small|[[a|' || c_custkey || ']]}}}}{{unknown|{{lang|fr|x}}}}.'", "c_name || ' ' || c_custkey || '.'"),
]

# name, template, plain text: over part (p_partkey, p_name, p_brand, p_size); it stands between < and >
TEMPLATES = [
    ("t03_constants", "'{{snd}}{{ndash}}{{en dash}}{{year}}{{yes}}{{n/a}}{{gold1}}{{pi}}{{-}}{{won|' || p_name || '}}'", "' - -–2024YesN/A1πWon'"),
    ("t04_last", "'{{lang|fr|' || p_name || '}}{{transl|a|b|' || p_size || '}}'", "p_name || p_size"),
    ("t05_first", "'{{flag|' || p_brand || '|x}}{{ill|' || p_size || '|de}}'", "p_brand || p_size"),
    ("t06_spaced", "'{{hlist|2=' || p_brand || '|a|' || p_size || '}}'", "'a ' || p_brand || ' ' || p_size"),
    ("t07_together", "'{{typo|' || p_brand || '|' || p_size || '}}'", "p_brand || p_size"),
    ("t08_vessels", "'{{USS|' || p_brand || '}}, {{HMS|' || p_brand || '|' || p_size || '}}'", "'USS ' || p_brand || ', HMS ' || p_brand || ' (' || p_size || ')'"),
    ("t09_ss", "'{{SS|' || p_brand || '|' || p_size || '}}'", "p_brand || ' (' || p_size || ')'"),
    ("t10_circa", "'{{circa|' || p_size || '}}, {{c.|' || p_size || '|' || p_partkey || '}}'", "'circa ' || p_size || ', c. ' || p_size || '-' || p_partkey"),
    ("t11_census", "'{{CensusAU|' || p_size || '}}'", "p_size || ' census'"),
    ("t12_fractions", "'{{frac|' || p_size || '}} {{frac|' || p_size || '|7}} {{fraction|1|' || p_size || '|9}}'", "'1/' || p_size || ' ' || p_size || '/7 1 ' || p_size || '/9'"),
    ("t13_nee", "'{{nee|' || p_brand || '}}'", "'née ' || p_brand"),
    ("t14_nowrap", "'{{nowrap|' || p_brand || '|k=' || p_size || '}}'", "p_brand || 'k=' || p_size"),
    ("t15_rating", "'{{rating|' || p_size || '|50}}'", "p_size || '/50'"),
    ("t16_convert", "'{{convert|' || p_size || '|km|mi}}, {{cvt|' || p_size || '|to|60|kg}}'", "p_size || ' km, ' || p_size || ' to 60 kg'"),
    ("t17_player", "'{{player|' || p_size || '|x|' || p_brand || '}}'", "p_size || ' ' || p_brand"),
    ("t18_stations", "'{{rws|' || p_brand || '}}{{stnlnk|a|b|' || p_size || '}}'", "p_brand || p_size"),
    ("t19_ship_class", "'{{sclass|' || p_brand || '|cruiser}}'", "p_brand || '-class cruiser'"),
    ("t20_small", "'{{small|' || p_name || '}}'", "p_name"),
    ("t21_sortname", "'{{sortname|' || p_brand || '|' || p_size || '}}'", "p_brand || ' ' || p_size"),
    ("t22_translation", "'{{translation|' || p_brand || '|' || p_size || '}}'", "'transl. ' || p_brand || ' - transl. ' || p_size"),
    ("t23_ascension", "'{{RA|' || p_size || '|5|6}}'", "p_size || 'h 5m 6s'"),
    ("t24_declination", "'{{DEC|' || p_size || '|5}}'", "p_size || '°5'''"),
    ("t25_value", "'{{val|' || p_size || '|2}}, {{val|e=' || p_size || '}}'", "p_size || ' ± 2, 10 ^ ' || p_size"),
    ("t26_rlp", "'{{rlp|' || p_size || '|' || p_brand || '}}'", "p_size || ', ' || p_brand"),
    ("t27_sic", "'{{sic|' || p_size || '|?|' || p_brand || '}}'", "p_size || p_brand"),
    ("t28_languages", "'{{lang-de|' || p_brand || '}}'", "p_brand"),
    ("t29_alum", "'{{alum|' || p_brand || '|' || p_size || '|nota=x}}'", "p_brand || ' (' || p_size || '): x'"),
    ("t30_anchor", "'{{visible anchor|' || p_brand || '}}'", "p_brand"),
    ("t31_quote", "'{{quote|' || p_brand || '|author=' || p_size || '|title=t|character=c}}'", "'\"' || p_brand || '\"-c, in ' || p_size || ', t'"),
    ("t32_poem", "'{{poemquote|' || p_brand || '|sign=' || p_size || '}}'", "'\"' || p_brand || '\"-' || p_size"),
    ("t33_as_of", "'{{As of|' || p_size || '|5|2}}, {{as of|since=y|' || p_size || '}}'", "'As of 2 May ' || p_size || ', Since ' || p_size"),
    ("t34_bible", "'{{bibleverse|' || p_brand || '|' || p_size || '}}'", "p_brand || ', ' || p_size"),
    ("t35_ubl", "'{{ubl|' || p_brand || '|' || p_size || '}}'", "p_brand || chr(10) || p_size"),
    ("t36_junction", "'{{jct|' || p_brand || '|' || p_size || '|SR|9}}'", "p_brand || '-' || p_size || '/SR-9'"),
    ("t37_coordinates", "'{{coord|' || p_size || '|N|7|W|display=title}} {{coord|' || p_size || '|5}}'", "p_size || '°N 7°W ' || p_size || '°N ' || p_size || '°E'"),
    ("t38_isbn", "'{{ISBN|' || p_partkey || '|' || p_size || '}}'", "p_partkey || ', ' || p_size"),
    ("t39_moments", "'{{end date|' || p_size || '|13}}, {{start date|' || p_partkey || '|5|3|10|30|15|Z}}'", "'13 ' || p_size || ', 10:30:15, May 3, ' || p_partkey || ' (UTC)'"),
    ("t40_film", "'{{film date|' || p_size || '|12|3}}'", "'December 3, ' || p_size"),
    ("t41_athlete", "'{{flagathlete|' || p_brand || '|' || p_size || '}}'", "p_brand || ' (' || p_size || ')'"),
    ("t42_inflation", "'{{inflation|US|' || p_size || '|1990}}'", "'US ' || p_size || ' (1990)'"),
    ("t43_birth", "'{{birth date|' || p_partkey || '|' || (p_size % 12 + 1) || '|4}}'", "['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December'][p_size % 12 + 1] || ' 4, ' || p_partkey"),
    ("t44_abbr", "'{{abbr|' || p_brand || '|' || p_size || '}}'", "p_brand || ' (' || p_size || ')'"),
    ("t45_olympic_athlete", "'{{flagIOCathlete|' || p_brand || '|GER}}, {{flagIOCmedalist|' || p_size || '|USA}}'", "p_brand || ' (GER), ' || p_size || ' (USA)'"),
    ("t46_olympic_country", "'{{flagIOC|GER}}, {{flagIOC|usa}}, {{flagIOC|GBR}}, {{flagIOC|NED}}, {{flagIOC|KOR}}, {{flagIOC|' || p_brand || '}}'", "'Germany, United States of America, United Kingdom of Great Britain and Northern Ireland, Netherlands, Korea (Republic of), ' || p_brand"),
    ("t47_color_box", "'{{color box|red|' || p_brand || '}}'", "p_brand"),
    ("t48_nihongo", "'{{nihongo|' || p_brand || '|東京|r|' || p_size || '|x}}'", "p_brand || '(東京, ' || p_size || ') x'"),
    ("t49_zh", "'{{zh|s=' || p_size || '|t=' || p_brand || '}}'", "p_brand || '; ' || p_size"),
    ("t50_korean", "'{{korean|' || p_brand || '|rr=' || p_size || '}}'", "'Korean: ' || p_brand || '; RR: ' || p_size"),
    ("t51_district", "'{{ushr|' || p_brand || '|' || p_size || '}}, {{ushr|' || p_brand || '|AL}}'", "p_brand || '''s ' || p_size || 'th congressional district, ' || p_brand || '''s at-large congressional district'"),
    ("t52_height", "'{{height|m=' || p_size || '|ft=6|precision=2}}'", "'6 ft ' || p_size || ' m'"),
    ("t53_font", "'{{font|text=' || p_brand || '}}'", "p_brand"),
]

for _name, _wikitext, _plain in MARKUP:
    _text_query(f"plain_text_{_name}", "customer", "c_custkey", _wikitext, _plain)
for _name, _wikitext, _plain in TEMPLATES:
    _text_query(f"template_{_name}", "part", "p_partkey", f"'(' || {_wikitext} || ' a)'", f"'(' || {_plain} || ' a)'")

#: Level-two, skipped-level, empty and unnamed sections for each supplier.
_ARTICLE = "'lead ' || s_name || chr(10) || '== One ==' || chr(10) || '  text ' || s_suppkey || '  ' || chr(10) || '==== Deep ====' || chr(10) || 'x' || chr(10) || 'y' || chr(10) || '=== Empty ===' || chr(10) || '== Bare' || chr(10) || '=== Sub ===' || chr(10) || 'z' || s_suppkey || chr(10) || '==' || chr(10) || 'u' || chr(10) || '== Last =='"
_ROWS = [
    (0, "NULL", 1, "s_name", "'lead ' || s_name || chr(10)"),
    (1, "0", 2, "'One'", "'text ' || s_suppkey || chr(10)"),
    (2, "1", 4, "'Deep'", "'x' || chr(10) || 'y' || chr(10)"),
    (4, "0", 2, "'Ba'", "''"),
    (5, "4", 3, "'Sub'", "'z' || s_suppkey || chr(10)"),
    (6, "0", 2, "'Unknown'", "'u' || chr(10)"),
]


@query("sections_flat", " UNION ALL ".join(f"SELECT s_suppkey, s_name AS title, {i} AS idx, CAST({p} AS INTEGER) AS parent_idx, {d} AS depth, {n} AS section_name, {t} AS text FROM supplier" for i, p, d, n, t in _ROWS))
def sections_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sections of an article a supplier, without those that hold no text."""
    docs = spread(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.expr(_ARTICLE).alias("text"))
    return sections(docs, "s_suppkey", "s_name", "text")


@query("section_tree_json", "SELECT s_suppkey, s_name AS name, 3 AS sections, 'x' || chr(10) || 'y' || chr(10) AS deep, 'Sub' AS sub, 0 AS leaves FROM supplier")
def section_tree_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested form, and what JSON paths find in it."""
    docs = spread(spark, sf_dir, "supplier").select("s_suppkey", section_tree("s_name", F.expr(_ARTICLE)).alias("tree"))
    at = lambda path: F.get_json_object("tree", path)
    return docs.select("s_suppkey", at("$.section_name").alias("name"), F.json_array_length(at("$.children")).alias("sections"), at("$.children[0].children[0].text").alias("deep"), at("$.children[1].children[0].section_name").alias("sub"), F.json_array_length(at("$.children[2].children")).alias("leaves"))


@query("article_pipeline", "SELECT c_custkey, idx, section_name, text FROM (SELECT c_custkey, 0 AS idx, c_name AS section_name, c_name || ' is a land.' || chr(10) AS text FROM customer UNION ALL SELECT c_custkey, 1, 'Past ' || c_nationkey, 'Founded in May ' || c_custkey || '.' || chr(10) FROM customer)")
def article_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wikitext to plain text to sections in one plan."""
    wikitext = "'' || c_name || ' is a [[Country|land]].<ref>x</ref>' || chr(10) || '== Past ' || c_nationkey || ' ==' || chr(10) || 'Founded in {{start date|' || c_custkey || '|5}}.' || chr(10) || '== See also ==' || chr(10) || '* x'"
    docs = spread(spark, sf_dir, "customer").select("c_custkey", "c_name", raw_to_plain_text(F.expr(wikitext)).alias("text"))
    return sections(docs, "c_custkey", "c_name", "text").select("c_custkey", "idx", "section_name", "text")
