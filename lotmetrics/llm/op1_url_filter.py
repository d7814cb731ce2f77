"""Host reputation by empirical Bayes, for url filtering. DataFrame functions only.

Labelled page outcomes are counted per host; a beta-binomial prior shrinks each
level towards the one above it: host to registered domain to suffix to all.
The strength of a level's prior is its moment estimate.  A host is blocked when
the lower bound of its posterior good rate is under `min_good`.

Nulls: a null url has an empty host and path; null labels and labels of unknown
pages count nothing.  Repeated pages are judged each, repeated labels count each.
A host without labels has its domain's posterior.  No pages give no rows.  Urls of any
length are read whole; other columns of pages and labels are not read, whatever
their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table

#: Verdict, host, path; the longest that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Suffixes of two labels; a parameter, to be extended as needed.
LONG_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "ac.jp", "co.jp", "ne.jp", "or.jp", "com.br", "net.br", "org.br", "co.nz", "org.nz", "co.za", "co.kr", "co.in", "com.cn", "com.tw", "com.hk", "com.sg", "com.mx", "com.ar", "com.tr", "com.pl", "com.ua")
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def suffix_of(host: Column) -> Column:
    last2 = F.substring_index(host, ".", -2)
    return F.when(last2.isin(*LONG_SUFFIXES), last2).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    last2 = F.substring_index(host, ".", -2)
    return F.when(last2.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(last2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        name = F.when(fits, F.lit(domain + start)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def strength(levels: DataFrame, least: float = 1.0, most: float = 1000.0) -> Column:
    """Moment estimate of a beta prior's pseudo-count over rows (n, s), as a scalar."""
    sums = levels.where("n > 0").agg(
        F.count("*").cast("double").alias("k"), F.sum("n").cast("double").alias("t"), F.sum("s").cast("double").alias("g"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("q"), F.sum(F.col("s").cast("double") * F.col("s") / F.col("n")).alias("r"),
    )
    mean = F.try_divide("g", "t")
    spread = F.col("r") - mean * F.col("g")  # sum of n (p - mean)^2
    rho = F.try_divide(F.try_divide(spread, mean * (1 - mean)) - (F.col("k") - 1), F.col("t") - F.try_divide("q", "t") - (F.col("k") - 1))
    m = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(least)), F.lit(most))).otherwise(F.lit(most))
    return sums.select(m.alias("m")).scalar()


def host_reputation(pages: DataFrame, outcomes: DataFrame, min_good: float = 0.5, z: float = 1.645) -> DataFrame:
    """pages: page_id, url; outcomes: page_id, good (0 or 1). One row per host: its posterior and verdict."""
    good = outcomes.select(F.col("page_id").alias("_id"), F.col("good").cast("long").alias("_good")).where("_id is not null and _good is not null")
    good = good.groupBy("_id").agg(F.count("*").alias("_n"), F.sum("_good").alias("_s"))
    seen = pages.select(F.col("page_id").alias("_page"), host_of(F.col("url")).alias("host")).join(good, F.col("_page") == F.col("_id"), "left")
    hosts = seen.groupBy("host").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("_s"), F.lit(0)).alias("s"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = suffixes.agg(F.coalesce(F.try_divide(F.sum("s").cast("double"), F.sum("n").cast("double")), F.lit(0.5)).alias("p")).scalar()

    def shrunk(mean: Column, m: Column) -> Column:
        return (F.col("s") + mean * m) / (F.col("n") + m)

    above = suffixes.select("suffix", shrunk(total, strength(suffixes)).alias("suffix_mean"))
    mid = domains.join(above, "suffix").select("suffix", "domain", shrunk(F.col("suffix_mean"), strength(domains)).alias("domain_mean"))
    m = strength(hosts)
    out = hosts.join(mid, ["suffix", "domain"]).withColumns({"mean": shrunk(F.col("domain_mean"), m), "weight": F.col("n") + m})
    bound = F.col("mean") - F.lit(z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return out.select("host", "domain", "suffix", "n", "s", "mean", bound.alias("lower"), F.when(bound < min_good, "block").otherwise("allow").alias("verdict"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, salts: int = 32, **how) -> DataFrame:
    """page_id, host, path, rule, verdict for each page: the longest rule's verdict, else the reputation's.

    Only blocked hosts are joined back, dealt over `salts` so that a host with a
    third of all pages spreads over that many tasks.
    """
    bad = host_reputation(pages, outcomes, **how).where("verdict = 'block'").select(F.col("host").alias("_host"))
    bad = bad.select("_host", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int"))
    joined = judged.join(bad, (F.col("host") == F.col("_host")) & (F.col("salt") == F.col("_salt")), "left")
    rest = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, rest).alias("verdict"))


def op1_host_reputation(spark, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes)


def host_posteriors(spark, sf_dir: str) -> DataFrame:
    """Each host's counts, posterior mean and its bound, to six digits."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    rows = host_reputation(table(spark, sf_dir, "pages"), outcomes)
    return rows.select("host", "n", "s", F.round("mean", 6).alias("mean"), F.round("lower", 6).alias("lower"), "verdict")


SQL = r"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) path from pages),
l as (select doc_id, count(quality) n, sum(quality) s from labels where doc_id is not null and quality is not null group by 1),
h0 as (select host, coalesce(sum(l.n), 0)::double n, coalesce(sum(l.s), 0)::double s from u left join l on l.doc_id = u.page_id group by 1),
h as (select *, case when array_to_string(string_split(host, '.')[-2:], '.') in (""" + ", ".join(f"'{x}'" for x in LONG_SUFFIXES) + r""") then array_to_string(string_split(host, '.')[-3:], '.') else array_to_string(string_split(host, '.')[-2:], '.') end dom,
  case when array_to_string(string_split(host, '.')[-2:], '.') in (""" + ", ".join(f"'{x}'" for x in LONG_SUFFIXES) + r""") then array_to_string(string_split(host, '.')[-2:], '.') else string_split(host, '.')[-1] end suf from h0),
d as (select suf, dom, sum(n) n, sum(s) s from h group by 1, 2),
x as (select suf, sum(n) n, sum(s) s from d group by 1),
a as (select 'h' lv, n, s from h union all select 'd', n, s from d union all select 'x', n, s from x),
m0 as (select lv, count(*) k, sum(n) t, sum(s) g, sum(n * n) q, sum(s * s / n) r from a where n > 0 group by 1),
m1 as (select lv, ((r - g / t * g) / nullif(g / t * (1 - g / t), 0) - (k - 1)) / nullif(t - q / t - (k - 1), 0) rho from m0),
m as (select v.lv, case when rho > 0 then least(greatest(1 / rho - 1, 1.0), 1000.0) else 1000.0 end m from (values ('h'), ('d'), ('x')) v(lv) left join m1 on m1.lv = v.lv),
xs as (select suf, (s + (select coalesce(sum(s) / nullif(sum(n), 0), 0.5) from x) * (select m from m where lv = 'x')) / (n + (select m from m where lv = 'x')) mu from x),
ds as (select d.suf, d.dom, (d.s + xs.mu * (select m from m where lv = 'd')) / (d.n + (select m from m where lv = 'd')) mu from d join xs on xs.suf = d.suf),
hs as (select h.host, (h.s + ds.mu * (select m from m where lv = 'h')) / (h.n + (select m from m where lv = 'h')) mu, h.n + (select m from m where lv = 'h') w from h join ds on ds.suf = h.suf and ds.dom = h.dom),
v as (select host, case when mu - 1.645 * sqrt(mu * (1 - mu) / (w + 1)) < 0.5 then 'block' else 'allow' end verdict from hs),
rules(what, dom, start) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f as (select u.host, u.path, arg_max(r.dom || r.start, length(r.dom || r.start)) rule, arg_max(r.what, length(r.dom || r.start)) what
  from (select distinct host, path from u) u join rules r on (u.host = r.dom or ends_with(u.host, '.' || r.dom)) and starts_with(u.path, r.start) group by 1, 2)
select u.page_id, u.host, u.path, f.rule, coalesce(f.what, v.verdict) verdict from u join v on v.host = u.host left join f on f.host = u.host and f.path = u.path
"""
HOSTS_SQL = SQL[: SQL.index("v as (select host")].rstrip().removesuffix(",") + """
select hs.host, h.n::bigint n, h.s::bigint s, round(mu, 6) as "mean", round(mu - 1.645 * sqrt(mu * (1 - mu) / (w + 1)), 6) "lower", case when mu - 1.645 * sqrt(mu * (1 - mu) / (w + 1)) < 0.5 then 'block' else 'allow' end verdict from hs join h on h.host = hs.host
"""
