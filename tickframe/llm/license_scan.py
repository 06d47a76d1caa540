"""License scan: ordered signature rules, gated by keywords, with overlapping detections resolved.

A text is reduced to its lower-case words. Every rule is a regular expression over these words, names keywords
of which a matching text has one or more, and has a priority (0 is the strongest). Texts without any keyword are not scanned;
in the others only the rules of which a keyword occurs are tried. A detection is suppressed when the interval of another
one of the same or a stronger priority contains it. All of this happens within a row, so nothing is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import ascii_lower, count_char, let, own_name, text_of, word_alternatives

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEVELS = 4


class Rule(NamedTuple):
    label: str
    priority: int
    score: float
    keyword: str
    pattern: str
    base: bool = False
    others: tuple[str, ...] = ()  # keywords of those alternatives of the pattern that lack the first one

    @property
    def keywords(self) -> tuple[str, ...]:
        return (self.keyword, *self.others)


# Phrases and labels of the base detections.
BASE_PHRASES = [
    ("gnu general public license", "gpl", "gnu"),
    ("apache license", "apache", "apache"),
    ("cc by", "cc-by", "cc"),
    ("mit license", "mit", "mit"),
]

# Words by which a pattern matches without its rule's keyword: pattern (or name) -> further keywords.
FURTHER = {
    r"(?:gnu )?affero general public license|gnu agpl": ("agpl",),
    r"the beer ?ware license": ("beerware",),
    r"(?:2|two) clause bsd license|bsd 2 clause license|simplified bsd license|freebsd license": ("freebsd",),
    r"gnu gpl|gpl(?: v)?[123]?|under the gpl": ("gpl1", "gpl2", "gpl3"),
    r"commercial license|for non ?commercial use only": ("noncommercial",),
    r"(?:see|read) the (?:file )?license|license agreement|licen[cs]e terms": ("licence",),
}

# label, keyword, name as a pattern over words, identifier as a pattern over words
NAMES = [
    ("afl-3.0", "academic", r"academic free license(?: version| v)? 3(?: 0)?", r"afl 3 0"),
    ("agpl-1.0", "affero", r"affero general public license(?: version| v)? 1(?: 0)?", r"agpl 1 0(?: only| or later)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version| v)? 3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("apache-1.0", "apache", r"apache(?: software)? license(?: version| v)? 1(?: 0)?", r"apache 1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: version| v)? 1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)? license(?: version| v)? 2(?: 0)?", r"apache 2 0"),
    ("artistic-1.0", "artistic", r"artistic license(?: version| v)? 1(?: 0)?", r"artistic 1 0(?: perl| cl8)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: version| v)? 2(?: 0)?", r"artistic 2 0"),
    ("beerware", "beer", r"the beer ?ware license", r"beerware"),
    ("blessing", "blessing", r"in place of a legal notice here is a blessing", r"blessing"),
    ("bsd-1-clause", "bsd", r"(?:1|one) clause bsd license|bsd 1 clause license", r"bsd 1 clause"),
    ("bsd-2-clause", "bsd", r"(?:2|two) clause bsd license|bsd 2 clause license|simplified bsd license|freebsd license", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:3|three) clause bsd license|bsd 3 clause license|(?:new|revised|modified) bsd license", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:4|four) clause bsd license|bsd 4 clause license|original bsd license", r"bsd 4 clause"),
    ("bsl-1.0", "boost", r"boost software license(?: version| v)? 1(?: 0)?", r"bsl 1 0"),
    ("busl-1.1", "business", r"business source license(?: version| v)? 1 1", r"busl 1 1"),
    ("cc-by-1.0", "cc", r"cc by 1 0", r"cc by 1 0"),
    ("cc-by-2.0", "cc", r"cc by 2 0", r"cc by 2 0"),
    ("cc-by-3.0", "cc", r"cc by 3 0", r"cc by 3 0"),
    ("cc-by-4.0", "cc", r"cc by 4 0", r"cc by 4 0"),
    ("cc-by-nc-3.0", "cc", r"cc by nc 3 0", r"cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc", r"cc by nc 4 0", r"cc by nc 4 0"),
    ("cc-by-nc-nd-4.0", "cc", r"cc by nc nd 4 0", r"cc by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc by nc sa 4 0", r"cc by nc sa 4 0"),
    ("cc-by-nd-4.0", "cc", r"cc by nd 4 0", r"cc by nd 4 0"),
    ("cc-by-sa-3.0", "cc", r"cc by sa 3 0", r"cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc", r"cc by sa 4 0", r"cc by sa 4 0"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cddl-1.0", "distribution", r"common development and distribution license(?: version| v)? 1(?: 0)?", r"cddl 1 0"),
    ("cddl-1.1", "distribution", r"common development and distribution license(?: version| v)? 1 1", r"cddl 1 1"),
    ("cecill-2.1", "cecill", r"cecill(?: free software)? license(?: agreement)?(?: version| v)? 2 1", r"cecill 2 1"),
    ("cpl-1.0", "common", r"common public license(?: version| v)? 1(?: 0)?", r"cpl 1 0"),
    ("ecl-2.0", "educational", r"educational community license(?: version| v)? 2(?: 0)?", r"ecl 2 0"),
    ("elastic-2.0", "elastic", r"elastic license(?: version| v)? 2(?: 0)?", r"elastic 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? 1(?: 0)?", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? 2(?: 0)?", r"epl 2 0"),
    ("eupl-1.1", "european", r"european union public licen[cs]e(?: version| v)? 1 1", r"eupl 1 1"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: version| v)? 1 2", r"eupl 1 2"),
    ("gfdl-1.2", "documentation", r"(?:gnu )?free documentation license(?: version| v)? 1 2", r"gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation license(?: version| v)? 1 3", r"gfdl 1 3(?: only| or later)?"),
    ("gpl-1.0", "general", r"(?:gnu )?general public license(?: version| v)? 1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public license(?: version| v)? 2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public license(?: version| v)? 3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("isc", "isc", r"isc license", r"isc"),
    ("json", "evil", r"shall be used for good not evil", r"json"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public license(?: version| v)? 2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lppl-1.3c", "latex", r"latex project public license(?: version| v)? 1 3c?", r"lppl 1 3c"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", r"mit 0"),
    ("mpl-1.0", "mozilla", r"mozilla public license(?: version| v)? 1(?: 0)?", r"mpl 1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? 1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? 2(?: 0)?", r"mpl 2 0"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl"),
    ("mulan-psl-2.0", "mulan", r"mulan psl v?2|mulan permissive software license(?: version| v)? 2", r"mulanpsl 2 0"),
    ("ncsa", "ncsa", r"university of illinois ncsa open source license", r"ncsa"),
    ("odbl-1.0", "database", r"open database license(?: version| v)? 1(?: 0)?", r"odbl 1 0"),
    ("ofl-1.1", "font", r"(?:sil )?open font license(?: version| v)? 1 1", r"ofl 1 1"),
    ("openssl", "openssl", r"openssl license", r"openssl"),
    ("osl-3.0", "open", r"open software license(?: version| v)? 3(?: 0)?", r"osl 3 0"),
    ("pddl-1.0", "dedication", r"public domain dedication and license(?: version| v)? 1(?: 0)?", r"pddl 1 0"),
    ("php-3.01", "php", r"php license(?: version| v)? 3 01", r"php 3 01"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql"),
    ("psf-2.0", "python", r"python software foundation license(?: agreement)?(?: version| v)? 2", r"psf 2 0"),
    ("python-2.0", "python", r"python license(?: version| v)? 2(?: 0)?", r"python 2 0"),
    ("ruby", "ruby", r"ruby license", r"ruby"),
    ("sspl-1.0", "server", r"server side public license(?: version| v)? 1", r"sspl 1 0"),
    ("unicode", "unicode", r"unicode license agreement", r"unicode dfs 2016"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense"),
    ("upl-1.0", "universal", r"universal permissive license(?: version| v)? 1(?: 0)?", r"upl 1 0"),
    ("vim", "vim", r"vim license", r"vim"),
    ("w3c", "w3c", r"w3c software(?: and document)? (?:notice and )?license", r"w3c"),
    ("wtfpl", "want", r"do what the fuck you want to public license", r"wtfpl"),
    ("x11", "x11", r"x11 license", r"x11"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", r"zlib"),
    ("zpl-2.1", "zope", r"zope public license(?: version| v)? 2 1", r"zpl 2 1"),
]

# label, priority, score, keyword, sentences of the license texts and looser mentions
NOTICES = [
    ("mit", 0, 1.0, "merchantability", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", 0, 1.0, "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 0, 1.0, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", 0, 1.0, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 0, 1.0, "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 0, 1.0, "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("gpl", 0, 1.0, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 0, 1.0, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", 0, 1.0, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", 0, 1.0, "fitness", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gfdl", 0, 1.0, "permission", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", 0, 1.0, "apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mpl-2.0", 0, 1.0, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", 0, 1.0, "eclipse", r"made available under the terms of the eclipse public license(?: v)? 2 0"),
    ("bsl-1.0", 0, 1.0, "boost", r"distributed under the boost software license version 1 0"),
    ("unlicense", 0, 1.0, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", 0, 1.0, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("cc0-1.0", 0, 1.0, "waived", r"has waived all copyright and related or neighboring rights"),
    ("ofl-1.1", 0, 1.0, "font", r"this font software is licensed under the sil open font license version 1 1"),
    ("wtfpl", 0, 1.0, "fuck", r"you just do what the fuck you want to"),
    ("agpl", 2, 0.7, "affero", r"(?:gnu )?affero general public license|gnu agpl"),
    ("lgpl", 2, 0.7, "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl", 2, 0.7, "library", r"(?:gnu )?library general public license"),
    ("lgpl", 2, 0.7, "lgpl", r"lgpl|gnu lgpl"),
    ("agpl", 2, 0.7, "agpl", r"agpl|gnu agpl"),
    ("gpl", 2, 0.7, "general", r"general public license"),
    ("gpl", 2, 0.7, "gpl", r"gnu gpl|gpl(?: v)?[123]?|under the gpl"),
    ("gfdl", 2, 0.7, "documentation", r"(?:gnu )?free documentation license"),
    ("apache", 2, 0.7, "apache", r"apache software license|apache licensed|under apache"),
    ("mpl", 2, 0.7, "mozilla", r"mozilla public license"),
    ("epl", 2, 0.7, "eclipse", r"eclipse public license"),
    ("bsd", 2, 0.6, "bsd", r"bsd (?:style )?licen[cs]ed?|bsd license"),
    ("mit", 2, 0.6, "mit", r"mit (?:style licen[cs]ed?|licen[cs]ed)|under(?: the)? mit"),
    ("ofl", 2, 0.6, "font", r"open font license"),
    ("artistic", 2, 0.6, "artistic", r"artistic license"),
    ("boost", 2, 0.6, "boost", r"boost software license"),
    ("cc-by-sa", 1, 0.8, "cc", r"cc by sa"),
    ("cc-by-nc", 1, 0.8, "cc", r"cc by nc"),
    ("cc-by-nd", 1, 0.8, "cc", r"cc by nd"),
    ("cc-by-nc-sa", 1, 0.85, "cc", r"cc by nc sa"),
    ("cc-by-nc-nd", 1, 0.85, "cc", r"cc by nc nd"),
    ("cc-by", 1, 0.8, "creative", r"creative commons attribution(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("cc-by-sa", 1, 0.85, "creative", r"creative commons attribution share ?alike(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("cc-by-nc", 1, 0.85, "creative", r"creative commons attribution non ?commercial(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("cc-by-nd", 1, 0.85, "creative", r"creative commons attribution no ?deriv(?:ative|ativ)e?s?(?: works)?(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("cc-by-nc-sa", 1, 0.9, "creative", r"creative commons attribution non ?commercial share ?alike(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("cc-by-nc-nd", 1, 0.9, "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative|ativ)e?s?(?: works)?(?: \d \d)?(?: international| unported| generic)?(?: public)?(?: license)?"),
    ("public-domain", 2, 0.6, "domain", r"(?:released into|dedicated to|placed in|in) the public domain|public domain dedication"),
    ("proprietary", 3, 0.4, "reserved", r"all rights reserved"),
    ("proprietary", 3, 0.4, "proprietary", r"proprietary and confidential|confidential and proprietary"),
    ("proprietary", 3, 0.4, "unauthorized", r"unauthorized (?:copying|reproduction|distribution) .{0,60}?(?:is )?(?:strictly )?prohibited"),
    ("commercial", 3, 0.4, "commercial", r"commercial license|for non ?commercial use only"),
    ("copyright", 3, 0.3, "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("license-mention", 3, 0.2, "license", r"(?:see|read) the (?:file )?license|license agreement|licen[cs]e terms"),
    ("license-mention", 3, 0.2, "licensed", r"licensed under|licensed to"),
]


def default_rules() -> list[Rule]:
    """The base phrases, the sentences, and three forms of every named license; earlier rules win ties."""
    rules = [Rule(label, 1, 0.8, keyword, phrase, True) for phrase, label, keyword in BASE_PHRASES]
    rules += [Rule(*row, others=FURTHER.get(row[-1], ())) for row in NOTICES]
    for label, keyword, name, identifier in NAMES:
        rules += [
            Rule(label, 1, 0.9, keyword, name, others=FURTHER.get(name, ())),
            Rule(label, 0, 1.0, keyword, f"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?(?:{name})", others=FURTHER.get(name, ())),
            Rule(label, 0, 0.95, "spdx", f"spdx license identifier (?:{identifier})"),
        ]
    return rules


def plain_words(text: Column) -> Column:
    """The words of a text in lower case, with one space around each."""
    words = F.trim(F.regexp_replace(ascii_lower(text), SEPARATORS, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _places(plain: Column, rule: Column) -> Column:
    """Intervals of words that match one rule. The text between matches gives the position of each."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    hits = F.regexp_extract_all(plain, pattern, F.lit(0))
    lengths = F.zip_with(
        F.split(plain, pattern, -1),
        hits,
        lambda gap, hit: F.struct(count_char(gap, " ").alias("gap"), count_char(hit, " ").alias("inner"), hit.isNotNull().alias("hit")),
    )
    none = F.array().cast("array<struct<start:bigint,`end`:bigint>>")
    start = F.struct(F.lit(-1).cast("bigint").alias("spaces"), none.alias("found"))

    def step(state, x):
        at = state["spaces"] + x["gap"]
        last = at + F.coalesce(x["inner"], F.lit(0))
        place = F.struct(at.cast("bigint").alias("start"), (last + 1).cast("bigint").alias("end"))
        found = F.when(x["hit"], F.concat(state["found"], F.array(place))).otherwise(state["found"])
        return F.struct(last.cast("bigint").alias("spaces"), found.alias("found"))

    return F.transform(
        F.aggregate(lengths, start, step)["found"],
        lambda p: F.struct(
            p["start"].alias("start"), (-p["end"]).alias("minus_end"), rule["priority"].alias("priority"), rule["number"].alias("rule"),
            rule["label"].alias("label"), rule["score"].alias("score"), rule["base"].alias("base"),
        ),
    )


def _resolve(found: Column) -> Column:
    """Mark detections that lie within one of the same or a stronger priority.

    Sorted by start and falling end, a detection lies within an earlier one when the largest end so far reaches its own.
    """
    reached = F.array(*[F.lit(0).cast("bigint")] * LEVELS)
    element = "struct<start:bigint,`end`:bigint,priority:int,rule:int,label:string,score:double,base:boolean,suppressed:boolean>"
    start = F.struct(reached.alias("reached"), F.array().cast(f"array<{element}>").alias("out"))

    def step(state, d):
        end = -d["minus_end"]
        hidden = F.array_max(F.slice(state["reached"], 1, d["priority"] + 1)) >= end
        item = F.struct(
            d["start"].alias("start"), end.alias("end"), d["priority"].alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"),
            d["score"].alias("score"), d["base"].alias("base"), hidden.alias("suppressed"),
        ).cast(element)
        reached = F.transform(state["reached"], lambda v, i: F.when(i == d["priority"], F.greatest(v, end)).otherwise(v))
        return F.struct(reached.alias("reached"), F.concat(state["out"], F.array(item)).alias("out"))

    return F.aggregate(F.sort_array(found), start, step)["out"]


def scan_licenses(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """All columns of ``docs`` and ``license_words`` (words of the text) and ``license_hits``.

    A hit has its interval of words ``[start, end)``, rule, label, score, whether the rule is a base phrase, and whether
    another hit suppresses it; hits are in order of their start. A null text counts as empty and gives no hits; rows are
    independent, so repeated rows give equal results. Columns of ``docs`` with these two names are replaced.
    """
    rules = default_rules() if rules is None else rules
    if any(not 0 <= r.priority < LEVELS for r in rules):
        raise ValueError(f"priorities go from 0 to {LEVELS - 1}")
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("number"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(float(r.score)).alias("score"),
                F.array(*[F.lit(f" {k} ") for k in r.keywords]).alias("keywords"), F.lit(r.pattern).alias("pattern"), F.lit(r.base).alias("base"),
            )
            for i, r in enumerate(rules)
        ]
    )
    gate = f" (?:{word_alternatives(k for r in rules for k in r.keywords)}) "
    plain_name = own_name(docs, "plain")
    plain = F.col(plain_name)
    found = F.flatten(F.transform(F.filter(table, lambda r: F.exists(r["keywords"], lambda k: F.contains(plain, k))), lambda r: _places(plain, r)))
    element = "array<struct<start:bigint,`end`:bigint,priority:int,rule:int,label:string,score:double,base:boolean,suppressed:boolean>>"
    kept = [c for c in docs.columns if c not in ("license_words", "license_hits")]
    return docs.select(*[F.col(f"`{c}`") for c in kept], plain_words(text_of(text)).alias(plain_name)).select(
        *[F.col(f"`{c}`") for c in kept],
        F.when(plain == " ", 0).otherwise(count_char(plain, " ") - 1).cast("bigint").alias("license_words"),
        F.when(plain.rlike(gate), _resolve(found)).otherwise(F.array().cast(element)).alias("license_hits"),
    )


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: number of words, base places, labels and the best score of the hits that stand."""
    scanned = scan_licenses(docs.select("doc_id", "text"))
    hits = F.col("license_hits")
    base = F.filter(hits, lambda h: h["base"])
    starts = F.transform(base, lambda h: h["start"])
    standing = F.filter(hits, lambda h: ~h["suppressed"])

    def labels(found):
        return F.array_join(F.sort_array(F.array_distinct(F.transform(found, lambda h: h["label"]))), ",")

    return scanned.select(
        "doc_id",
        F.col("license_words").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.concat(base, standing)).alias("labels"),
        F.coalesce(F.array_max(F.transform(standing, lambda h: h["score"])), F.lit(0.0)).alias("score"),
        F.size(standing).cast("bigint").alias("n_hits"),
    )
