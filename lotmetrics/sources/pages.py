"""Elements, tables and forms of landed pages, and the tax tables on them, as column expressions: a page is split where elements begin."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entities that the pages use.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&ccedil;", "ç"), ("&atilde;", "ã"), ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&oacute;", "ó"), ("&uacute;", "ú"), ("&otilde;", "õ"), ("&ecirc;", "ê"), ("&acirc;", "â"), ("&ocirc;", "ô"), ("&amp;", "&"))
#: Parts of the header words of the tax tables, and of the word for a code.
PLACE_WORD, CODE_WORD, RATE_WORD, PARISH_WORD, DEDUCTION_WORDS = "munic", "dig", "urban", "freguesia", ("depend", "dedu")
#: Answers in the deduction tables, the link to such a table and its parameter.
YES, NO, DEDUCTION_PAGE, PLACE_PARAMETER = "sim", ("não", "nao"), "consultaDeducao", "codigoMunicipio"
#: Deductions are for one, two, and three or more dependants.
DEPENDANTS = 3


def resolved(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def plain_text(html: Column) -> Column:
    """The text of a piece of a page: no tags, entities resolved, blanks as one."""
    return F.trim(F.regexp_replace(resolved(F.regexp_replace(html, "<[^>]+>", " ")), r"[\s\x{00A0}]+", " "))


def elements(html: Column, *names: str) -> Column:
    """array<struct<attributes, body>>: the elements of the names in order. One ends where it is closed, where the next begins, or with the text."""
    either = "|".join(names)
    begun = F.split(html, rf"(?i)<(?:{either})(?=[\s/>])")

    def parted(piece: Column) -> Column:
        attributes = F.substring_index(piece, ">", 1)
        body = F.split(F.substr(piece, F.char_length(attributes) + 2), rf"(?i)</(?:{either})\s*>", 2)
        return F.struct(attributes.alias("attributes"), F.get(body, F.lit(0)).alias("body"))

    return F.transform(F.slice(begun, 2, F.greatest(F.size(begun), F.lit(1))), parted)


def attribute(attributes: Column, name: str) -> Column:
    """The value of an attribute, quoted either way or bare; null without it."""
    forms = ('"([^"]*)"', "'([^']*)'", r"([^\s\"'>]+)")
    found = [F.regexp_extract(attributes, rf"(?i)(?:^|\s){name}\s*=\s*{form}", 1) for form in forms]
    has = [F.regexp_like(attributes, F.lit(rf"(?i)(?:^|\s){name}\s*=\s*{form}")) for form in forms]
    return F.coalesce(*[F.when(h, v) for h, v in zip(has, found, strict=True)])


def table_rows(page: Column) -> Column:
    """array<array<string>>: the cells of each table row that has any text."""
    cells = F.transform(elements(page, "tr"), lambda r: F.transform(elements(r["body"], "td", "th"), lambda c: plain_text(c["body"])))
    return F.filter(cells, lambda r: F.array_join(r, "") != "")


def select_options(page: Column) -> Column:
    """map<string, array<string>>: the values of each named list of a form, blank ones left out."""
    lists = F.transform(elements(page, "select"), lambda s: F.struct(attribute(s["attributes"], "name").alias("k"), F.transform(elements(s["body"], "option"), lambda o: attribute(o["attributes"], "value")).alias("v")))
    return F.map_from_entries(F.transform(F.filter(lists, lambda s: s["k"].isNotNull()), lambda s: F.struct(s["k"], F.filter(s["v"], lambda v: F.trim(v) != ""))))


def number_in(text: Column, grouped: bool) -> Column:
    """The first number of a text; grouped: points and blanks part thousands and only a comma is decimal."""
    digits = F.regexp_extract(text, r"(\d[\d .]*(?:,\d+)?)" if grouped else r"(\d+(?:[.,]\d+)?)", 1)
    return F.replace(F.translate(digits, " .", "") if grouped else digits, F.lit(","), F.lit(".")).try_cast("double")


def rate(text: Column) -> Column:
    """A property tax rate as a fraction: percent from 0.1 to 1, or a fraction; null outside 0.001 to 0.01."""
    said = number_in(text, False)
    share = F.when(said.between(0.1, 1), said / 100).otherwise(said)
    return F.when(share.between(0.001, 0.01), F.round(share, 6))


def money(text: Column) -> Column:
    """1 234,50 or 1.234 as a number."""
    return number_in(text, True)


def district_rates(pages: DataFrame) -> DataFrame:
    """code, name, rate, by_parish and ded_1 to ded_3 (the deductions for dependants) of the municipalities on district pages (column page).

    The header is the first row that names municipality and urban property; rows before
    it do not count. Columns are found by words of the header; a page without columns
    for deductions has none.
    """
    says = lambda cell, word: F.lower(cell).contains(word)
    heads = lambda r: F.exists(r, lambda c: says(c, PLACE_WORD)) & F.exists(r, lambda c: says(c, RATE_WORD))
    rows = pages.select(table_rows(F.col("page")).alias("rows")).withColumn("head_at", F.array_position(F.transform("rows", heads), True).cast("int")).where("head_at > 0")
    rows = rows.withColumn("head", F.element_at("rows", F.col("head_at")))
    # the places (from 0) of the header's cells that satisfy a condition
    where = lambda cond: F.filter(F.transform("head", lambda c, i: F.when(cond(c), i)), lambda i: i.isNotNull())
    names = F.concat(where(lambda c: says(c, PLACE_WORD) & ~says(c, CODE_WORD)), where(lambda c: says(c, PLACE_WORD)))
    known = {"name": F.get(names, F.lit(0)), "rate": F.get(where(lambda c: says(c, RATE_WORD)), F.lit(0)), "parish": F.get(where(lambda c: says(c, PARISH_WORD)), F.lit(0)), "ded": where(lambda c: reduce(lambda a, w: a | says(c, w), DEDUCTION_WORDS, F.lit(False)))}
    cells = rows.withColumns({f"at_{k}": v for k, v in known.items()}).select("at_name", "at_rate", "at_parish", "at_ded", F.explode(F.slice("rows", F.col("head_at") + 1, F.size("rows"))).alias("r"))
    cells = cells.where(F.size("r") > F.greatest("at_name", "at_rate"))
    told = F.coalesce(F.get("r", F.col("at_parish")) != "", F.lit(False))
    code = F.regexp_extract(F.array_join(F.slice("r", F.lit(1), F.col("at_name") + 1), " "), r"\b(\d{4})\b", 1)
    name = F.ltrim(F.get("r", F.col("at_name")), F.lit("0123456789 -–."))
    deductions = [money(F.get("r", F.get("at_ded", F.lit(k)))).alias(f"ded_{k + 1}") for k in range(DEPENDANTS)]
    out = cells.select(F.nullif(code, F.lit("")).alias("code"), F.trim(name).alias("name"), rate(F.get("r", F.col("at_rate"))).alias("rate"), told.alias("by_parish"), *deductions)
    return out.where((F.col("name") != "") & (F.col("rate").isNotNull() | F.col("by_parish")))


def latest_entries(pairs: Column) -> Column:
    """A map of structs k, v, of which the last counts for each k."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)))


def family_deduction(page: Column) -> Column:
    """map<int, double>: the deduction for 1, 2, 3 and more dependants; 0 where it does not apply; null on a page without such a table."""
    answer = lambda r: F.lower(F.trim(F.get(r, F.lit(2))))
    told = F.filter(table_rows(page), lambda r: F.regexp_like(F.get(r, F.lit(0)), F.lit(r"^\s*\d")) & answer(r).isin(YES, *NO))
    pairs = F.transform(told, lambda r: F.struct(F.least(F.regexp_extract(F.get(r, F.lit(0)), r"(\d)", 1).cast("int"), F.lit(DEPENDANTS)).alias("k"), F.when(answer(r) == YES, money(F.get(r, F.lit(1)))).otherwise(0.0).alias("v")))
    return F.when(F.size(told) > 0, latest_entries(pairs))


def deduction_links(page: Column) -> Column:
    """map<string, string>: the address of each municipality's deductions, by its code of four digits."""
    targets = F.transform(elements(page, "a"), lambda a: resolved(attribute(a["attributes"], "href")))
    coded = F.transform(targets, lambda h: F.struct(F.regexp_extract(h, rf"{PLACE_PARAMETER}=(\d{{4}})", 1).alias("k"), h.alias("v")))
    return latest_entries(F.filter(coded, lambda p: p["v"].contains(DEDUCTION_PAGE) & (p["k"] != "")))


def tax_fields(rates: DataFrame) -> DataFrame:
    """place and the published fields of a place's tax (dico, year, rate, by_parish, ded_1 to ded_3): imi_rate, imi_year, imi_parish_rates, imi_ded_1 to imi_ded_3. Of several years the last."""
    last = rates.where("dico is not null").groupBy("dico").agg(F.max_by(F.struct(*rates.columns), "year").alias("x")).select("x.*")
    held = [F.col(f"ded_{k}").alias(f"imi_ded_{k}") if f"ded_{k}" in rates.columns else F.lit(None).cast("double").alias(f"imi_ded_{k}") for k in range(1, DEPENDANTS + 1)]
    return last.select(F.col("dico").alias("place"), F.round("rate", 6).alias("imi_rate"), F.col("year").cast("int").alias("imi_year"), F.coalesce("by_parish", F.lit(False)).alias("imi_parish_rates"), *held)
