"""Counts and shares by place, area and group of types."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitally.functions import fixed_values as fv
from civitally.functions import text
from civitally.operators import counting as ct
from civitally.plans.marts import area_share
from civitally.session import cut_lineage
from civitally.sources.readers import area_centroids

from . import sql_parts as sp
from .registry import query
from .tables import crimes, read

M = sp.MARTS
PLACE = "location_description"


TIDY = text.tidy_text


def _kept_places():
    return text.has_text(TIDY(PLACE)) & text.not_containing(TIDY(PLACE), fv.LOCATION_EXCLUSIONS)


def _category(column=PLACE):
    return text.classify(column, fv.LOCATION_CATEGORIES, fv.LOCATION_CATEGORY_DEFAULT)


def _is_type(name):
    return F.col("primary_type") == name


@query(f"{sp.WITH} SELECT id, {sp.TIDY} AS location_description FROM crimes")
def tidy_text(spark, sf_dir):
    return crimes(spark, sf_dir).select("id", TIDY(PLACE).alias(PLACE))


@query(f"{sp.WITH} SELECT {sp.normal(PLACE)} AS label, count(*) AS total FROM crimes"
       " WHERE location_description IS NOT NULL GROUP BY 1")
def normalize_label(spark, sf_dir):
    return ct.sum_by_label(crimes(spark, sf_dir), PLACE, {"label": text.normalize_label(PLACE)},
                           where=F.col(PLACE).isNotNull())


@query(f"{sp.WITH} SELECT "
       + sp.case_words(PLACE, fv.LOCATION_CATEGORIES, fv.LOCATION_CATEGORY_DEFAULT)
       + " AS location_category, count(*) AS total FROM crimes GROUP BY 1")
def classify_location(spark, sf_dir):
    return ct.sum_by_label(crimes(spark, sf_dir), PLACE, {"location_category": _category()})


@query(f"{sp.WITH} SELECT " + sp.case_words(PLACE, fv.TRANSIT_CATEGORIES, fv.TRANSIT_DEFAULT)
       + " AS location_type, count(*) AS total FROM crimes GROUP BY 1")
def classify_transit(spark, sf_dir):
    kind = text.classify(PLACE, fv.TRANSIT_CATEGORIES, fv.TRANSIT_DEFAULT)
    return ct.sum_by_label(crimes(spark, sf_dir), PLACE, {"location_type": kind})


@query(f"{sp.WITH} SELECT " + sp.case_words(PLACE, fv.AIRPORT_CATEGORIES, fv.AIRPORT_DEFAULT)
       + " AS location_type, count(*) AS total FROM crimes GROUP BY 1")
def classify_airport(spark, sf_dir):
    kind = text.classify(PLACE, fv.AIRPORT_CATEGORIES, fv.AIRPORT_DEFAULT)
    return ct.sum_by_label(crimes(spark, sf_dir), PLACE, {"location_type": kind})


@query(f"{sp.WITH} SELECT "
       + sp.case_values("primary_type", fv.TYPE_GROUPS, fv.TYPE_GROUP_DEFAULT)
       + " AS crime_category, count(*) AS total FROM crimes GROUP BY 1")
def classify_value_groups(spark, sf_dir):
    group = text.classify_values("primary_type", fv.TYPE_GROUPS, fv.TYPE_GROUP_DEFAULT)
    return ct.sum_by_label(crimes(spark, sf_dir), "primary_type", {"crime_category": group})


@query(f"{sp.WITH} SELECT location_description, count(*) AS total FROM crimes WHERE NOT"
       f" regexp_matches(location_description, '(?i).*({'|'.join(fv.CLEANING_EXCLUSIONS)}).*')"
       " GROUP BY 1")
def exclude_keywords(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), [PLACE],
                       where=text.not_containing(PLACE, fv.CLEANING_EXCLUSIONS))


def _venue_counts(spark, sf_dir):
    at_venue = text.has_text(TIDY(PLACE)) & TIDY(PLACE).rlike(fv.SPORT_PATTERN)
    return ct.sum_by_label(crimes(spark, sf_dir), PLACE, {PLACE: TIDY(PLACE)}, "total_crimes",
                           other_keys=["primary_type"], where=at_venue)


@query(M["sport_location_crimes"])
def venue_groups(spark, sf_dir):
    group = text.classify_values("primary_type", fv.TYPE_GROUPS, fv.TYPE_GROUP_DEFAULT)
    return ct.sum_by(_venue_counts(spark, sf_dir), {"crime_category": group}, "total_crimes",
                     "total_crimes")


@query(M["sport_location_crimes_by_type"])
def venue_types(spark, sf_dir):
    return _venue_counts(spark, sf_dir)


def _category_types(spark, sf_dir):
    return ct.sum_by_label(
        crimes(spark, sf_dir), PLACE, {"location_category": _category(TIDY(PLACE))}, "total",
        other_keys=["primary_type"], where=_kept_places())


@query(M["crimes_by_location"])
def location_counts(spark, sf_dir):
    return ct.sum_by_label(
        crimes(spark, sf_dir), PLACE, {"location_category": _category(TIDY(PLACE))},
        "total_crimes", where=_kept_places())


@query(M["crimes_by_location_and_type"])
def top_type_per_category(spark, sf_dir):
    return ct.top_item_per_group(_category_types(spark, sf_dir), "location_category",
                                 "primary_type", total_name="location_total")


_RANKED = (
    f"{sp.WITH_TIDY}, {sp.KEPT_PLACES}, counts AS (SELECT location_description, primary_type,"
    " count(*) AS total FROM kept GROUP BY ALL), totals AS (SELECT location_description,"
    " count(*) AS location_total FROM kept GROUP BY 1 HAVING count(*) > 100)"
    " SELECT location_description, primary_type, total, location_total,"
    " CAST(row_number() OVER (PARTITION BY location_description ORDER BY total DESC,"
    " primary_type NULLS FIRST) AS INTEGER) AS rank"
    " FROM counts JOIN totals USING (location_description)"
)


@query(_RANKED)
def rank_types_big_labels(spark, sf_dir):
    counts = ct.sum_by_label(crimes(spark, sf_dir), PLACE, {PLACE: TIDY(PLACE)},
                             other_keys=["primary_type"], where=_kept_places())
    ranked = ct.rank_within(counts, PLACE, "primary_type", total_name="location_total")
    return ranked.filter("location_total > 100")


@query(f"SELECT * FROM ({_RANKED}) WHERE rank <= 3")
def top_types_per_label(spark, sf_dir):
    return rank_types_big_labels(spark, sf_dir).filter("rank <= 3")


@query(M["community_area_crimes"])
def area_counts(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["community_area"], "total_crimes",
                       text.has_text("community_area"))


@query(M["downtown_vs_residential_theft_robbery"])
def area_rate(spark, sf_dir):
    return area_share(crimes(spark, sf_dir).filter(text.has_text("community_area")))


def _place_rate(spark, sf_dir, rules, default, crime, part, rate):
    counts = ct.count_by(crimes(spark, sf_dir), [PLACE, "primary_type"], "n",
                         F.col(PLACE).isNotNull())
    kind = {"location_type": text.classify(TIDY(PLACE), rules, default)}
    return ct.share_by(counts, kind, _is_type(crime), part, "total_crimes", rate, weight="n")


@query(M["transit_vs_commercial_robbery_count"])
def transit_rate(spark, sf_dir):
    return _place_rate(spark, sf_dir, fv.TRANSIT_CATEGORIES, fv.TRANSIT_DEFAULT, "ROBBERY",
                       "robbery_count", "robbery_rate")


@query(M["airport_theft_count_comparison"])
def airport_rate(spark, sf_dir):
    return _place_rate(spark, sf_dir, fv.AIRPORT_CATEGORIES, fv.AIRPORT_DEFAULT, "THEFT",
                       "theft_count", "theft_rate")


@query(M["theft_by_location"])
def share_by_label(spark, sf_dir):
    counts = ct.sum_by_label(crimes(spark, sf_dir), PLACE, {PLACE: TIDY(PLACE)}, "n",
                             other_keys=["primary_type"], where=text.has_text(TIDY(PLACE)))
    label = {PLACE: text.normalize_label(PLACE)}
    return ct.share_by(counts, label, _is_type("THEFT"), "total_thefts", "total_crimes",
                       weight="n")


@query(M["theft_by_location"])
def join_aggregates(spark, sf_dir):
    """The same shares as two aggregates joined on the label.

    Both sides read the written label counts. Without the cut the join's not-null test on
    the normalised label would run the whole regex chain on every row, once per side.
    """
    counts = cut_lineage(ct.sum_by_label(
        crimes(spark, sf_dir), PLACE, {PLACE: text.normalize_label(TIDY(PLACE))}, "n",
        other_keys=["primary_type"], where=text.has_text(TIDY(PLACE))))
    thefts = ct.sum_by(counts, [PLACE], "n", "total_thefts", _is_type("THEFT"))
    totals = ct.sum_by(counts, [PLACE], "n", "total_crimes")
    return ct.join_totals(thefts, totals, [PLACE])


@query(f"SELECT location_description, round(total_thefts / CAST(total_crimes AS DOUBLE), 6) AS theft_rate"
       f" FROM ({M['theft_by_location']}) ORDER BY total_thefts / CAST(total_crimes AS DOUBLE) DESC,"
       " location_description LIMIT 10")
def top_share(spark, sf_dir):
    shares = share_by_label(spark, sf_dir)
    rated = shares.select(PLACE, (F.col("total_thefts") / F.col("total_crimes")).alias("theft_rate"))
    return ct.top_rows(rated, 10, "theft_rate", [PLACE]).withColumn(
        "theft_rate", F.round("theft_rate", 6))


@query(f"SELECT location_category, total_crimes FROM ({M['crimes_by_location']})"
       " ORDER BY total_crimes DESC, location_category LIMIT 10")
def top_labels(spark, sf_dir):
    return ct.top_rows(location_counts(spark, sf_dir), 10, "total_crimes", ["location_category"])


def _centroid_values():
    return ", ".join(
        "('{}', {}::DOUBLE, {}::DOUBLE)".format(*area) for area in fv.AREA_CENTROIDS)


@query(f"SELECT community_area, total_crimes, lat, lng FROM (SELECT * FROM ({M['community_area_crimes']})"
       f" ORDER BY total_crimes DESC, community_area LIMIT 15) JOIN (VALUES {_centroid_values()})"
       " AS centre(community_area, lat, lng) USING (community_area)")
def top_areas_geo(spark, sf_dir):
    top = ct.top_rows(area_counts(spark, sf_dir), 15, "total_crimes", ["community_area"])
    return top.join(area_centroids(spark), "community_area")


# The same operators over the test tables' own columns, with the two dimensions joined in.
_PART_RULES = (("Aged", ("OLD",)), ("Round", ("RING", "ROD")), ("Fixings", ("BOLT", "GEAR")))

_INC = ("inc AS (SELECT l_shipdate AS date, p_type AS primary_type, p_name AS location_description,"
        " s_nationkey AS area FROM lineitem JOIN part ON l_partkey = p_partkey"
        " JOIN supplier ON l_suppkey = s_suppkey)")


@query(f"WITH {_INC} SELECT " + sp.case_words(PLACE, _PART_RULES, "Other")
       + " AS category, primary_type, count(*) AS total FROM inc GROUP BY ALL")
def part_category_types(spark, sf_dir):
    """Rows are counted per part before the join, so a hot part joins as one row."""
    per_part = ct.count_by(read(spark, sf_dir, "lineitem"), ["l_partkey"], "n")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    joined = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    labels = ct.sum_by(joined, ["p_name", "p_type"], "n", "n")
    keys = {"category": text.classify("p_name", _PART_RULES, "Other"),
            "primary_type": F.col("p_type")}
    return ct.sum_by(labels, keys, "n", "total")


@query(f"WITH {_INC} SELECT n_name, count(*) AS total_crimes FROM inc JOIN nation ON area = n_nationkey"
       " GROUP BY 1 ORDER BY total_crimes DESC, n_name LIMIT 15")
def top_nations(spark, sf_dir):
    per_supplier = ct.count_by(read(spark, sf_dir, "lineitem"), ["l_suppkey"], "n")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_area = ct.sum_by(
        per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")), ["s_nationkey"], "n", "n")
    named = per_area.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return ct.top_rows(ct.sum_by(named, ["n_name"], "n", "total_crimes"), 15, "total_crimes", ["n_name"])
