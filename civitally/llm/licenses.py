"""License detection by ordered signature rules, with DataFrame functions only.

A text is reduced to its lower-case words. Rules are regular expressions over the words joined by
spaces; a rule is tried only where its keyword and a cue of its form occur, and rules are tried
only on texts that hold the first word of a cue. Every match holds both. A rule's priority says how explicit it is: identifier tags come
before grants, grants before titles, titles before mere mentions. A detection that lies inside
another one of the same or a better priority is suppressed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .registry import query, table
from .rows import ROW_KEY, once, with_row_key

#: Words of a phrase, and its label, looked for in every text.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Confidence of a detection by priority; a phrase alone has that of BASE.
CONFIDENCE, BASE = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.4}, 0.5

# (label, keyword, name in words, identifier in words)
NAMES = (
    ("mit", "mit", r"(?:the )?(?:mit|expat|mit expat)(?: x11)?", r"mit"),
    ("mit-0", "attribution", r"mit no attribution", r"mit 0"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)? version 1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", r"apache 2 0"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original|old|4 clause|four clause) bsd|bsd (?:4|four) clause", r"bsd 4 clause"),
    ("0bsd", "bsd", r"zero clause bsd|bsd zero clause", r"0bsd"),
    ("gpl-1.0", "general", r"(?:gnu )?general public license version 1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? version 2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: either)? version 2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license(?: either)? version 3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version 3(?: 0)?)?", r"agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation license(?: version 1 3)?", r"gfdl 1 3(?: only| or later)?"),
    ("mpl-1.1", "mozilla", r"mozilla public license version 1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? 2 0", r"mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? 1 0", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? 2 0", r"epl 2 0"),
    ("cddl-1.0", "distribution", r"common development and distribution license(?: version 1 0)?", r"cddl 1 0"),
    ("cpl-1.0", "common", r"common public license(?: version 1 0)?", r"cpl 1 0"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: version| v)?(?: 1 2)?", r"eupl 1 2"),
    ("isc", "isc", r"isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?", r"zlib"),
    ("boost-1.0", "boost", r"boost software license(?: version 1 0)?", r"bsl 1 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("artistic-2.0", "artistic", r"artistic license(?: version)? 2 0", r"artistic 2 0"),
    ("artistic-1.0", "artistic", r"artistic license(?: version)? 1 0", r"artistic 1 0"),
    ("psf-2.0", "python", r"python software foundation license(?: version 2)?", r"psf 2 0"),
    ("php-3.01", "php", r"php license(?: version)?(?: 3 01)?", r"php 3 01"),
    ("ruby", "ruby", r"ruby", r"ruby"),
    ("openssl", "openssl", r"openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source", r"ncsa"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl"),
    ("ofl-1.1", "font", r"sil open font license(?: version 1 1)?", r"ofl 1 1"),
    ("afl-3.0", "academic", r"academic free license(?: version| v)?(?: 3 0)?", r"afl 3 0"),
    ("osl-3.0", "open", r"open software license(?: version| v)?(?: 3 0)?", r"osl 3 0"),
    ("upl-1.0", "universal", r"universal permissive license(?: version| v)?(?: 1 0)?", r"upl 1 0"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by", "by", r"(?:cc by|creative commons attribution)(?: international)?(?: [1-4] 0)?(?! nc| nd| sa| non| no| share)", r"cc by [1-4] 0"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] 0)?", r"cc by sa [1-4] 0"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] 0)?(?! sa| nd)", r"cc by nc [1-4] 0"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] 0)?", r"cc by nd [1-4] 0"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] 0)?", r"cc by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] 0)?", r"cc by nc nd [1-4] 0"),
    ("odbl-1.0", "database", r"open database license(?: version| v)?(?: 1 0)?", r"odbl 1 0"),
    ("odc-by-1.0", "data", r"open data commons attribution license(?: version| v)?(?: 1 0)?", r"odc by 1 0"),
    ("gpl", "general", r"(?:gnu )?(?<!lesser )(?<!affero )general public license", r"gpl"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license", r"lgpl"),
    ("apache", "apache", r"(?:the )?apache(?: software)? license", r"apache"),
    ("bsd", "bsd", r"bsd(?: style)?", r"bsd"),
    ("proprietary", "proprietary", r"(?:a )?proprietary", r"licenseref proprietary"),
    ("commercial", "commercial", r"(?:a )?commercial", r"licenseref commercial"),
)
# (priority, words before the name, the part of a rule's name used, words after it)
FORMS = (
    (1, r"spdx license identifier ", "identifier", r""),
    (1, r"spdx short identifier ", "identifier", r""),
    (1, r"license expression ", "identifier", r""),
    (2, r"licen[sc]ed under (?:the )?(?:terms of (?:the )?)?", "name", r"(?: licen[sc]e)?"),
    (2, r"(?:released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?", "name", r"(?: licen[sc]e)?"),
    (2, r"(?:governed by|subject to) (?:the )?(?:terms of (?:the )?)?", "name", r"(?: licen[sc]e)?"),
    (3, r"", "title", r""),
    (4, r"licen[sc]e ", "identifier", r""),
)
# Rules that name no license of the list: (priority, label, keyword, expression).
OTHERS = (
    (2, "public-domain", "domain", r"(?:released into|placed in|dedicated to) the public domain"),
    (3, "public-domain", "domain", r"public domain dedication"),
    (3, "all-rights-reserved", "reserved", r"all rights reserved"),
    (4, "copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    (4, "license-reference", "license", r"see (?:the )?(?:accompanying )?(?:file )?license(?: file| txt| md)?"),
    (4, "unknown-license", "licensed", r"licensed under (?:the )?[^ ]+"),
    (4, "unknown-license", "license", r"(?:end user|software) license agreement"),
)


#: Of each form, in order: strings of which every match holds one.
CUES = (("spdx",), ("spdx",), ("licen",), ("licen",),
        ("released under", "distributed under", "published under", "available under", "provided under"),
        ("governed by", "subject to"), ("licen",), ("licen",))
#: The same of each of the other rules.
OTHER_CUES = (("domain",), ("domain",), ("reserved",), ("copyright",), ("licen",), ("licen",), ("licen",))
#: Of which a lower-cased text must hold one before any rule is tried: the cues' first words, so that
#: what stands between words does not matter.
GATE = tuple(sorted({cue.split()[0] for cues in CUES + OTHER_CUES for cue in cues}))


def rule_cues() -> list[tuple[str, ...]]:
    """The cues of every rule, in the order of the rules."""
    return [cues for cues in CUES for _ in NAMES] + list(OTHER_CUES)


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, expression) of all rules."""
    made = []
    for priority, before, part, after in FORMS:
        for label, keyword, name, ident in NAMES:
            # A title says license: where the name does not always, the word follows it.
            always = "licen" in re.sub(r"\(\?:[^()]*\)\?", "", name)
            title = f"(?:{name})(?: licen[sc]e)?" if always else f"(?:{name}) licen[sc]e"
            words = {"name": f"(?:{name})", "title": title, "identifier": f"(?:{ident})"}[part]
            key = re.match("[a-z0-9]+", ident)[0] if part == "identifier" else keyword
            made.append((priority, label, key, before + words + after))
    return made + list(OTHERS)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _detections() -> Column:
    """Detections of all rules in ``spaced``: the words of a text with one space around each.

    Matches are marked at both ends, so that their words are found by a walk over the words.
    """
    table_ = ", ".join(
        f"named_struct('p', {p}, 'label', {_literal(label)}, 'key', {_literal(key)}, "
        f"'cues', array({', '.join(map(_literal, cues))}), 'rule', {_literal(f'(?<= )(?:{rule})(?= )')})"
        for (p, label, key, rule), cues in zip(rules(), rule_cues(), strict=True))
    marked = "split(trim(regexp_replace(spaced, r.rule, '\\u0001$0\\u0002')), ' ')"
    places = ("filter(transform({}, (w, i) -> CASE WHEN {} THEN i END), i -> i IS NOT NULL)").format
    return once(f"""flatten(transform(filter(array({table_}), r -> contains(spaced, r.key) AND exists(r.cues, c -> contains(spaced, c))), r ->
        transform(arrays_zip({places(marked, "startswith(w, '\\u0001')")}, {places(marked, "endswith(w, '\\u0002')")}),
            x -> named_struct('start', x['0'], 'end', x['1'] + 1, 'p', r.p, 'label', r.label))))""")


def _phrase_places(words: tuple[str, ...]) -> str:
    test = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(words))
    n = len(words)
    return f"CASE WHEN size(words) >= {n} THEN filter(sequence(0, size(words) - {n}), i -> {test}) ELSE CAST(array() AS array<int>) END"


_RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def with_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Null counts as empty. Labels are distinct and sorted, empty without any; score is the
    largest confidence, 0 without any. Equal rows have equal results; null ids do not
    matter, as rows are told apart by their content.
    """
    kept = [c for c in docs.columns if c not in (*_RESULTS, *ROW_KEY)]
    keyed = with_row_key(docs.select(*kept)).withColumn(
        "n_words", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"))
    lower = F.lower(F.coalesce("text", F.lit("")))
    speaks = F.lit(False)
    for part in GATE:
        speaks = speaks | lower.contains(part)
    plain = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    read = keyed.where(speaks).select(*ROW_KEY, F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)).alias("words"))
    read = read.dropDuplicates(ROW_KEY).withColumn("spaced", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    base = read.select(*ROW_KEY, *(once(_phrase_places(words)).alias(label) for words, label in PHRASES))
    every = F.concat(*(F.col(label) for _, label in PHRASES))
    base = base.select(
        *ROW_KEY, F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.filter(F.array(*(F.when(F.size(label) > 0, label_name) for label, label_name in (
            (label, F.lit(label)) for _, label in PHRASES))), lambda x: x.isNotNull())).alias("named"))
    found = read.select(*ROW_KEY, F.inline(_detections()))
    before = Window.partitionBy(*ROW_KEY).orderBy("start", F.col("end").desc(), "p", "label").rowsBetween(
        Window.unboundedPreceding, -1)
    reach = F.lit(None).cast("int")
    for p in CONFIDENCE:
        reach = F.when(F.col("p") == p, F.max(F.when(F.col("p") <= p, F.col("end"))).over(before)).otherwise(reach)
    stays = found.withColumn("reach", reach).where("reach IS NULL OR reach < end")
    confidence = F.lit(0.0)
    for p, value in CONFIDENCE.items():
        confidence = F.when(F.col("p") == p, value).otherwise(confidence)
    own = stays.groupBy(*ROW_KEY).agg(F.collect_set("label").alias("own"), F.max(confidence).alias("confidence"))
    none = F.expr("CAST(array() AS array<string>)")
    labelled = base.join(own, ROW_KEY, "left").select(
        *ROW_KEY, "n_base", "first_word", "last_word", F.array_join("named", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("named", F.coalesce("own", none)))), ",").alias("labels"),
        F.greatest(F.coalesce("confidence", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE).otherwise(0.0)).alias("score"))
    held = keyed.where(speaks).join(labelled, ROW_KEY).select(*kept, *_RESULTS)
    empty = {"n_base": F.lit(0).cast("long"), "first_word": F.lit(None).cast("long"),
             "last_word": F.lit(None).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    return held.unionByName(keyed.where(~speaks).withColumns(empty).select(*kept, *_RESULTS))


@query()
def op6_license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, phrases, labels and score of every document."""
    return with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
