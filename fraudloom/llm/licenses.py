"""License scan by ordered signature rules, all in DataFrame expressions.

A text is reduced to lower-case words joined by spaces. Hundreds of regular
expressions over these words (permission notices, warranty clauses and file
headers of the licenses, their short identifiers, and the title of each license
in each form in which texts refer to it) are gated by a keyword each, and the
texts as a whole by a few word stems, so most texts meet no rule. Every match is an interval of words
with a priority. A match that lies inside another one of the same or a better
priority is suppressed; the labels of the others are reported.

Base phrases are counted apart from that and never suppressed.

Null and empty texts have no words, no label and score 0. Texts of any length are
scanned whole. Rows are scanned one by one, so repeated rows give equal results. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import LOWER, UPPER, whole_text

# The base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# label, keyword every match contains, title as a regular expression over words.
TITLES = (
    ("mit", "mit", "mit license"),
    ("mit", "mit", "mit x11 license|x11 mit license"),
    ("mit-0", "mit", "mit no attribution( license)?|mit 0"),
    ("apache-2", "apache", "apache (software )?license (version )?2( 0)?|apache 2( 0)?( license)?|apache license v2( 0)?"),
    ("apache-1.1", "apache", "apache (software )?license (version )?1 1"),
    ("apache", "apache", "apache (software )?license"),
    ("gpl-3", "gnu g", "gnu (general public license|gpl) (version |v)3( 0)?"),
    ("gpl-3", "gpl", "gplv3|gpl v?3( 0)?( only| or later)?"),
    ("gpl-2", "gnu g", "gnu (general public license|gpl) (version |v)2( 0)?"),
    ("gpl-2", "gpl", "gplv2|gpl v?2( 0)?( only| or later)?"),
    ("gpl", "gnu", "gnu (general public license|gpl)"),
    ("lgpl-3", "lesser", "gnu lesser general public license (version |v)3( 0)?"),
    ("lgpl-3", "lgpl", "lgplv3|lgpl v?3( 0)?"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license (version |v)2 1"),
    ("lgpl-2.1", "lgpl", "lgplv2 1|lgpl v?2 1"),
    ("lgpl", "lesser", "gnu lesser general public license"),
    ("lgpl", "library", "gnu library general public license"),
    ("agpl-3", "affero", "(gnu )?affero general public license (version |v)3( 0)?"),
    ("agpl-3", "agpl", "agplv3|agpl v?3( 0)?"),
    ("agpl", "affero", "(gnu )?affero general public license"),
    ("gfdl", "documentation", "gnu free documentation license"),
    ("bsd-2", "bsd", "(simplified|2 clause|two clause) bsd license|bsd 2 clause( license)?"),
    ("bsd-3", "bsd", "(new|modified|revised|3 clause|three clause) bsd license|bsd 3 clause( license)?"),
    ("bsd-4", "bsd", "(original|4 clause|four clause) bsd license|bsd 4 clause( license)?"),
    ("bsd-0", "bsd", "(zero clause|0 clause) bsd license|0bsd|bsd zero clause( license)?"),
    ("bsd", "bsd", "bsd( style)? license"),
    ("isc", "isc", "isc license"),
    ("mpl-2", "mozilla", "mozilla public license (version |v ?)?2( 0)?"),
    ("mpl-2", "mpl 2", "mpl 2 0"),
    ("mpl-1.1", "mozilla", "mozilla public license (version |v ?)?1 1"),
    ("mpl-1.1", "mpl 1", "mpl 1 1"),
    ("mpl", "mozilla", "mozilla public license"),
    ("epl-2", "eclipse", "eclipse public license (version |v ?)?2( 0)?"),
    ("epl-2", "epl 2", "epl 2 0"),
    ("epl-1", "eclipse", "eclipse public license (version |v ?)?1( 0)?"),
    ("epl-1", "epl 1", "epl 1 0"),
    ("epl", "eclipse", "eclipse public license"),
    ("cddl", "common development", "common development and distribution license"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("artistic-2", "artistic", "artistic license (version )?2( 0)?"),
    ("artistic", "artistic", "artistic license"),
    ("boost", "boost", "boost software license"),
    ("zlib", "zlib", "zlib( libpng)? license"),
    ("unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "what the", "do what the fuck you want to public license"),
    ("python", "python", "python software foundation license"),
    ("openssl", "openssl", "openssl license"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("ms-pl", "microsoft", "microsoft public license"),
    ("ms-rl", "microsoft", "microsoft reciprocal license"),
    ("ofl", "font", "sil open font license"),
    ("odbl", "database", "open (data commons open )?database license"),
    ("odc-by", "attribution", "open data commons attribution license"),
    ("cc0", "cc0", "cc0( 1 0)?( universal)?"),
    ("cc0", "zero", "creative commons zero"),
    ("cc-by-nc-nd", "nc nd", "cc by nc nd( [234] [05])?"),
    ("cc-by-nc-sa", "nc sa", "cc by nc sa( [234] [05])?"),
    ("cc-by-nc", "by nc", "cc by nc( [234] [05])?"),
    ("cc-by-nd", "by nd", "cc by nd( [234] [05])?"),
    ("cc-by-sa", "by sa", "cc by sa( [234] [05])?"),
    ("cc-by", "cc by", "cc by( [234] [05])?"),
    ("cc-by-nc-nd", "commons", "creative commons attribution non ?commercial no ?deriv(ative)?s"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial"),
    ("cc-by-nd", "commons", "creative commons attribution no ?deriv(ative)?s"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike"),
    ("cc-by", "commons", "creative commons attribution"),
    ("public-domain", "public domain", "(in|into|to) the public domain"),
    ("proprietary", "proprietary", "proprietary license"),
)

_TERMS = "(([^ ]+ )?under (the )?(terms (and conditions )?of (the )?)?)?"
_FSF = "as published by the free software foundation (either )?version"
# Label, keyword and words of notices, clauses and headers that licenses prescribe.
NOTICES = (
    ("mit", "person obtaining a copy of this software",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions of the software",
     "(the above )?copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("boost", "person or organization obtaining a copy",
     "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("isc", "this software for any purpose",
     "permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice"),
    ("bsd-0", "this software for any purpose",
     "permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted "
     "the software is provided as is"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification (are|is) permitted"),
    ("bsd-3", "endorse or promote", "neither the names? of (the )?([^ ]+ ){0,12}?contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "except in compliance with the license", "you may not use this file except in compliance with the license"),
    ("apache-2", "distributed under the license", "software distributed under the license is distributed on an as is basis"),
    ("gpl-3", "general public license", f"{_TERMS}gnu general public license {_FSF} 3( of the license)?"),
    ("gpl-2", "general public license", f"{_TERMS}gnu general public license {_FSF} 2( of the license)?"),
    ("gpl", "verbatim copies of this license", "everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("lgpl-3", "lesser general", f"{_TERMS}gnu lesser general public license {_FSF} 3( of the license)?"),
    ("lgpl-2.1", "lesser general", f"{_TERMS}gnu lesser general public license {_FSF} 2 1( of the license)?"),
    ("lgpl-2", "library general", f"{_TERMS}gnu library general public license {_FSF} 2( of the license)?"),
    ("agpl-3", "affero general", f"{_TERMS}(gnu )?affero general public license {_FSF} 3( of the license)?"),
    ("gfdl", "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "source code form", "this source code form is subject to the terms of the mozilla public license v(ersion)? 2 0"),
    ("mpl-1.1", "mozilla public", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-2", "accompanying materials", "accompanying materials (are|is) made available under the terms of the eclipse public license (v|version )?2 0"),
    ("epl-1", "accompanying materials", "accompanying materials (are|is) made available under the terms of the eclipse public license (v|version )?1 0"),
    ("cddl", "common development", "contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", "licensed under the eupl (version |v)?1 [012]( or as soon they will be approved)?"),
    ("artistic", "standard version", "distribute verbatim copies of the source form of the standard version of this package"),
    ("zlib", "authors be held liable", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "verbatim or modified copies", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("python", "making python", "psf is making python (version )?([^ ]+ ){0,6}?available to licensee"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project"),
    ("postgresql", "without a written agreement",
     "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("ms-pl", "ms pl", "microsoft public license ms pl|this license governs use of the accompanying software ms pl"),
    ("ofl", "font software", "this font software is licensed under the sil open font license( version 1 [01])?"),
    ("odbl", "database", "this ([^ ]+ ){0,8}?is made available under the open database license"),
    ("odc-by", "odc attribution", "this ([^ ]+ ){0,8}?is made available under the odc attribution license"),
    ("cc0", "dedicated the work", "has dedicated the work to the public domain"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
)
# Short identifiers, as words.
IDENTIFIERS = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("apache-2", "apache 2 0"), ("apache-1.1", "apache 1 1"), ("gpl-3", "gpl 3 0"),
    ("gpl-3", "gpl 3 0 only"), ("gpl-3", "gpl 3 0 or later"), ("gpl-2", "gpl 2 0"), ("gpl-2", "gpl 2 0 only"),
    ("gpl-2", "gpl 2 0 or later"), ("lgpl-3", "lgpl 3 0"), ("lgpl-3", "lgpl 3 0 only"), ("lgpl-3", "lgpl 3 0 or later"),
    ("lgpl-2.1", "lgpl 2 1"), ("lgpl-2.1", "lgpl 2 1 only"), ("lgpl-2.1", "lgpl 2 1 or later"), ("agpl-3", "agpl 3 0"),
    ("agpl-3", "agpl 3 0 only"), ("agpl-3", "agpl 3 0 or later"), ("gfdl", "gfdl 1 3"), ("gfdl", "gfdl 1 2"),
    ("bsd-2", "bsd 2 clause"), ("bsd-3", "bsd 3 clause"), ("bsd-4", "bsd 4 clause"), ("bsd-0", "0bsd"), ("isc", "isc"),
    ("mpl-2", "mpl 2 0"), ("mpl-1.1", "mpl 1 1"), ("epl-2", "epl 2 0"), ("epl-1", "epl 1 0"), ("cddl", "cddl 1 0"),
    ("cddl", "cddl 1 1"), ("eupl", "eupl 1 2"), ("eupl", "eupl 1 1"), ("artistic-2", "artistic 2 0"), ("boost", "bsl 1 0"),
    ("zlib", "zlib"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("python", "psf 2 0"), ("python", "python 2 0"),
    ("openssl", "openssl"), ("postgresql", "postgresql"), ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("ofl", "ofl 1 1"),
    ("odbl", "odbl 1 0"), ("odc-by", "odc by 1 0"), ("cc0", "cc0 1 0"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"),
    ("cc-by-nd", "cc by nd 4 0"), ("cc-by-nc", "cc by nc 4 0"), ("cc-by-nc-sa", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", "cc by nc nd 4 0"), ("cc-by", "cc by 3 0"), ("cc-by-sa", "cc by sa 3 0"),
)
# Ahead of an identifier, priority and confidence: the tag of file headers, the field of package descriptions.
_TAGS = (("spdx license identifier", 0, 1.0), ("license", 1, 0.8))

_GRANT = "(licen[cs]ed|released|distributed|published|available|provided|offered)"
# form, priority (0 is best), confidence; {} stands for the title.
FORMS = (
    (_GRANT + " under (the )?(terms (and conditions )?of (the )?)?({})", 1, 0.95),
    ("(under|subject to|governed by|covered by) (the )?(terms (and conditions )?of (the )?)?({})", 1, 0.9),
    ("(copy|text|terms|conditions) of (the )?({})", 1, 0.8),
    ("({}) (applies|for more details|for details|as published)", 1, 0.8),
    ("(see|read) (the )?({})", 2, 0.7),
    ("({})", 2, 0.6),
)
# Texts without any of these have no match: every title or base phrase holds one.
_STEMS = (
    r"hereby[^0-9a-z]+granted|redistribution[^0-9a-z]+and|unencumbered[^0-9a-z]+software|held[^0-9a-z]+liable|endorse[^0-9a-z]+or"
    r"|advertising[^0-9a-z]+materials|unauthorized[^0-9a-z]+copying|openssl[^0-9a-z]+project|proprietary[^0-9a-z]+and"
    r"|shall[^0-9a-z]+be[^0-9a-z]+included|verbatim[^0-9a-z]+copies|written[^0-9a-z]+agreement|eupl|ms[^0-9a-z]pl"
    r"|licen[cs]|gpl|mit[^0-9a-z]+(0|no[^0-9a-z])|apache|bsd|mpl|epl|cc0|cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"
    r"|creative|public|mit[^0-9a-z]")
# All stems begin with two of these letters: most places are passed over without trying each stem.
_GATE = "(?i)(?=[abceghlmoprsuvw][cdehinprsu])(?:" + _STEMS + ")"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A word with what follows it, in either case of letters.
_WORD_AND_GAP = r"[a-z0-9A-Z\x80-\x{10FFFF}]*+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
_MARK = "\x01"


def signatures() -> list[tuple[str, int, float, str, str]]:
    """All rules in order: label, priority, confidence, keyword, expression."""
    rules = [
        (label, priority, confidence, keyword, form.format(title))
        for form, priority, confidence in FORMS for label, keyword, title in TITLES
    ]
    rules += [(label, 0, 0.98, keyword, expression) for label, keyword, expression in NOTICES]
    rules += [
        (label, priority, confidence, f"{tag} {words}", f"{tag} {words}")
        for tag, priority, confidence in _TAGS for label, words in IDENTIFIERS
    ]
    return sorted(rules, key=lambda rule: rule[1])


def _rules(rules) -> Column:
    return F.array(*[
        F.struct(
            F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(float(confidence)).alias("confidence"),
            F.lit(keyword).alias("keyword"), F.lit(f"(?<![^ ])(?:{expression})(?![^ ])").alias("expression"))
        for label, priority, confidence, keyword, expression in rules])


def _n_words(text: Column) -> Column:
    """Number of words: one letter is put for each word and gap, and for the gap ahead of the first; no list is built."""
    marks = F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), _WORD_AND_GAP, "x")
    return (F.length(marks) - 1).cast("bigint")


def _matches(rules: Column, norm: Column) -> Column:
    """All matches as structs of first word, minus last word, priority, label, confidence; sorted."""
    used = F.filter(rules, lambda r: F.contains(norm, r["keyword"]) & F.rlike(norm, r["expression"]))

    def of(rule: Column) -> Column:
        words = F.split(F.regexp_replace(norm, rule["expression"], F.lit(_MARK + "$0")), " ")
        starts = F.filter(
            F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit(_MARK)), i)), lambda i: i.isNotNull())
        spans = F.transform(
            F.regexp_extract_all(norm, rule["expression"], F.lit(0)),
            lambda m: F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit(""))))
        return F.zip_with(starts, spans, lambda start, more: F.struct(
            start.alias("first"), (-(start + more)).alias("minus_last"), rule["priority"].alias("priority"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    return F.array_sort(F.flatten(F.transform(used, of)))


_UNSUPPRESSED = """
aggregate(found,
  named_struct('labels', cast(array() as array<string>), 'score', 0D, 'r0', -1, 'r1', -1, 'r2', -1),
  (a, m) -> if(
    -m.minus_last <= case m.priority when 0 then a.r0 when 1 then greatest(a.r0, a.r1) else greatest(a.r0, a.r1, a.r2) end,
    a,
    named_struct(
      'labels', array_union(a.labels, array(m.label)), 'score', greatest(a.score, m.confidence),
      'r0', if(m.priority = 0, greatest(a.r0, -m.minus_last), a.r0),
      'r1', if(m.priority = 1, greatest(a.r1, -m.minus_last), a.r1),
      'r2', if(m.priority = 2, greatest(a.r2, -m.minus_last), a.r2))))
"""


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""
    base = _rules([(label, 0, 0.9, phrase, phrase) for label, phrase in BASE])
    text = whole_text()
    lowered = F.translate(text, UPPER, LOWER)
    norm = F.trim(F.regexp_replace(lowered, _NOT_WORD, " "))
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _n_words(text).alias("n_words"),
        F.when(text.rlike(_GATE), norm).alias("norm"))
    nothing = F.array().cast(
        "array<struct<first:int,minus_last:int,priority:int,label:string,confidence:double>>")
    words = F.col("norm")
    matched = read.select(
        "doc_id", "n_words",
        F.when(words.isNotNull(), _matches(base, words)).otherwise(nothing).alias("base"),
        F.when(words.isNotNull(), _matches(_rules(signatures()), words)).otherwise(nothing).alias("found"))
    resolved = matched.withColumn("kept", F.expr(_UNSUPPRESSED))
    base_labels = F.array_distinct(F.transform("base", lambda m: m["label"]))
    return resolved.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda m: m["first"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("base", lambda m: m["first"])).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("kept.labels"))), ",").alias("labels"),
        F.greatest(F.when(F.size("base") > 0, F.lit(0.9)).otherwise(F.lit(0.0)), F.col("kept.score")).alias("score"))
