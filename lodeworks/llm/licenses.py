"""License scans: ordered signature patterns behind a keyword gate, with suppression of overlaps.

Everything is DataFrame functions, one row in and one row out, without a shuffle. A
document is read as one line of lower-case words. Only signatures whose keyword the
line contains are matched. Every match is a detection, an interval of the line. Some
signatures name further words that have to follow the match, in order, at any distance
but before the signature's next match; the interval then ends with the last of them. A
detection is dropped if a stronger one (greater priority, else longer, else earlier
rule) holds its interval. The rest name the labels. Base phrases are plain word
sequences, counted at every place, overlapping ones included, and never suppressed.

The work is linear in the line and in the matches, but for their sort: a signature
matches the line once, and one sweep over the sorted detections keeps, for each
priority, how far the detections of it or of greater ones reach.

Defined results: null and empty text have no words, no labels and score 0; equal rows
give equal results, one each; no rows give no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import bound, swept, word_line, words_in

# Fixed values of the contract: phrase and label.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licence families: label, pattern of the name as lower-case words, a word every match contains.
FAMILIES = [
    ("mit", r"(?:the )?(?:mit|expat|x11)", ("mit", "expat", "x11")),
    ("apache-2", r"(?:the )?apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", ("apache",)),
    ("apache-1.1", r"(?:the )?apache(?: software)?(?: license)?(?: version)? 1 1", ("apache",)),
    ("gpl-2", r"(?:the )?(?:gnu )?(?:gpl|general public license)(?: version)? ?v?2(?: 0)?", ("gpl", "general public")),
    ("gpl-3", r"(?:the )?(?:gnu )?(?:gpl|general public license)(?: version)? ?v?3(?: 0)?", ("gpl", "general public")),
    ("lgpl-2.1", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?v?2 1", ("lgpl", "lesser general")),
    ("lgpl-3", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?v?3(?: 0)?", ("lgpl", "lesser general")),
    ("agpl-3", r"(?:the )?(?:gnu )?(?:agpl|affero general public license)(?: version)? ?v?3(?: 0)?", ("agpl", "affero")),
    ("bsd-2-clause", r"(?:the )?(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)", ("bsd",)),
    ("bsd-3-clause", r"(?:the )?(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", ("bsd",)),
    ("bsd-4-clause", r"(?:the )?(?:original bsd|bsd 4 clause|4 clause bsd)", ("bsd",)),
    ("isc", r"(?:the )?isc", ("isc",)),
    ("mpl-1.1", r"(?:the )?(?:mpl|mozilla public license)(?: version)? 1 1", ("mpl", "mozilla")),
    ("mpl-2", r"(?:the )?(?:mpl|mozilla public license)(?: version)? 2(?: 0)?", ("mpl", "mozilla")),
    ("epl-1", r"(?:the )?(?:epl|eclipse public license)(?: version)? 1(?: 0)?", ("epl", "eclipse")),
    ("epl-2", r"(?:the )?(?:epl|eclipse public license)(?: version)? 2(?: 0)?", ("epl", "eclipse")),
    ("cddl-1", r"(?:the )?(?:cddl|common development and distribution license)(?: version)?(?: 1(?: 0)?)?", ("cddl", "common development")),
    ("cc0-1", r"(?:the )?(?:cc0|creative commons zero)(?: 1 0)?", ("cc0", "commons zero")),
    ("cc-by-nc-nd", r"(?:the )?(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|no derivatives|noderivs)", ("cc by", "cc attribution", "creative commons")),
    ("cc-by-nc-sa", r"(?:the )?(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)", ("cc by", "cc attribution", "creative commons")),
    ("cc-by-nc", r"(?:the )?(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)", ("cc by", "cc attribution", "creative commons")),
    ("cc-by-nd", r"(?:the )?(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|no derivatives|noderivs)", ("cc by", "cc attribution", "creative commons")),
    ("cc-by-sa", r"(?:the )?(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)", ("cc by", "cc attribution", "creative commons")),
    ("cc-by", r"(?:the )?(?:cc by|creative commons attribution)", ("cc by", "cc attribution", "creative commons")),
    ("unlicense", r"(?:the )?unlicense", ("unlicense",)),
    ("wtfpl", r"(?:the )?(?:wtfpl|do what the fuck you want to public license)", ("wtfpl", "do what the")),
    ("zlib", r"(?:the )?zlib(?: libpng)?", ("zlib",)),
    ("boost-1", r"(?:the )?boost software license(?: version)?(?: 1 0)?", ("boost",)),
    ("artistic-2", r"(?:the )?artistic license(?: version)?(?: 2 0)?", ("artistic",)),
    ("python-2", r"(?:the )?(?:psf|python software foundation) license(?: version)?(?: 2)?", ("psf", "python")),
    ("php-3", r"(?:the )?php license(?: version)?(?: 3(?: 0\d?)?)?", ("php",)),
    ("ruby", r"(?:the )?ruby", ("ruby",)),
    ("eupl-1.2", r"(?:the )?(?:eupl|european union public license)(?: version)?(?: 1 2)?", ("eupl", "european union")),
    ("ofl-1.1", r"(?:the )?(?:sil )?open font license(?: version)?(?: 1 1)?", ("open font",)),
    ("odbl-1", r"(?:the )?(?:odbl|open database license)(?: 1 0)?", ("odbl", "open database")),
    ("odc-by-1", r"(?:the )?(?:odc by|open data commons attribution)(?: license)?(?: 1 0)?", ("odc", "open data commons")),
    ("ms-pl", r"(?:the )?(?:ms pl|microsoft public license)", ("ms pl", "microsoft public")),
    ("gfdl-1.3", r"(?:the )?(?:gnu )?(?:gfdl|free documentation license)(?: version)?(?: 1 [123])?", ("gfdl", "documentation license")),
    ("public-domain", r"(?:the )?public domain", ("public domain",)),
    ("proprietary", r"(?:a )?proprietary", ("proprietary",)),
]

# How a licence is named: priority, confidence, text before and after the name, a word every match contains.
FORMS = [
    (50, 1.0, r"spdx license identifier ", r"(?: only| or later)?", "spdx"),
    (45, 0.95, r"licen[sc]ed (?:to [^ ]+ )?under(?: the terms of)?(?: the)? ", r"(?: public)?(?: licen[sc]e)?", "licen"),
    (40, 0.95, r"(?:distributed|released|published|provided) under(?: the terms of)?(?: the)? ", r"(?: licen[sc]e)?", "ed under"),
    (35, 0.9, r"subject to(?: the terms of)?(?: the)? ", r"(?: licen[sc]e)?", "subject to"),
    (35, 0.9, r"governed by(?: the terms of)?(?: the)? ", r"(?: licen[sc]e)?", "governed by"),
    (30, 0.9, r"(?:under|accept|by) (?:the )?", r" licen[sc]e", "licen"),
    (20, 0.85, r"licen[sc]es? (?:is )?", r"", "licen"),
    (10, 0.8, r"", r" licen[sc]e(?: version)?", "licen"),
]

# Standard notices of versioned licences: label, name, version, a word every match contains.
VERSIONED = [
    ("gpl-1", r"(?:gnu )?(?:gpl|general public license)", r"1(?: 0)?", ("gpl", "general public")),
    ("gpl-2", r"(?:gnu )?(?:gpl|general public license)", r"2(?: 0)?", ("gpl", "general public")),
    ("gpl-3", r"(?:gnu )?(?:gpl|general public license)", r"3(?: 0)?", ("gpl", "general public")),
    ("lgpl-2", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)", r"2(?: 0)?(?! 1(?![^ ]))", ("lgpl", "general public")),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)", r"2 1", ("lgpl", "general public")),
    ("lgpl-3", r"(?:gnu )?(?:lgpl|lesser general public license)", r"3(?: 0)?", ("lgpl", "lesser general")),
    ("agpl-3", r"(?:gnu )?(?:agpl|affero general public license)", r"3(?: 0)?", ("agpl", "affero")),
    ("mpl-1.1", r"(?:mpl|mozilla public license)", r"1 1", ("mpl", "mozilla")),
    ("mpl-2", r"(?:mpl|mozilla public license)", r"2(?: 0)?", ("mpl", "mozilla")),
    ("epl-1", r"(?:epl|eclipse public license)", r"1(?: 0)?", ("epl", "eclipse")),
    ("epl-2", r"(?:epl|eclipse public license)", r"2(?: 0)?", ("epl", "eclipse")),
]
AS_PUBLISHED = r"(?: as published by the free software foundation(?: inc)?)?"
CREATIVE_COMMONS = [
    ("cc-by-nc-nd", r"non ?commercial no ?deriv(?:atives|ative works|s)"), ("cc-by-nc-sa", r"non ?commercial share ?alike"),
    ("cc-by-nc", r"non ?commercial"), ("cc-by-nd", r"no ?deriv(?:atives|ative works|s)"), ("cc-by-sa", r"share ?alike"), ("cc-by", r""),
]
MIT_GRANT = "permission is hereby granted free of charge to any person obtaining a copy of"
BSD_GRANT = "redistribution and use in source and binary forms"
ISC_GRANT = "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"
# Wordings of licence texts and notices: label, priority, confidence, pattern, keyword, a second one every match contains,
# words that follow.
WORDINGS = [
    ("mit", 60, 1.0, f"{MIT_GRANT} this software and associated documentation files(?: the software to deal in the software)?",
     "granted free of charge", "documentation files"),
    ("ncsa", 60, 1.0, f"{MIT_GRANT} this software and associated documentation files the software to deal with the software",
     "granted free of charge", "to deal with the software"),
    ("ofl-1.1", 60, 1.0, f"{MIT_GRANT} the font software", "granted free of charge", "font software"),
    ("boost-1", 60, 1.0, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
     "and accompanying documentation", "granted free of charge", "or organization"),
    ("mit", 15, 0.8, "permission is hereby granted free of charge", "granted free of charge", "permission"),
    ("bsd-4-clause", 62, 1.0, BSD_GRANT, "redistribution and use", "advertising materials",
     "all advertising materials mentioning", "neither the name"),
    ("bsd-3-clause", 60, 1.0, BSD_GRANT, "redistribution and use", "neither the name", "neither the name"),
    ("bsd-2-clause", 60, 1.0, BSD_GRANT, "redistribution and use", "distribution this software",
     "provided with the distribution this software is provided"),
    ("apache-1.1", 62, 1.0, BSD_GRANT, "redistribution and use", "end user documentation",
     "the end user documentation included with the redistribution"),
    ("bsd", 15, 0.8, BSD_GRANT, "redistribution and use", "binary forms"),
    ("bsd", 5, 0.8, r"(?:under (?:the |a )?)?bsd(?: style| type| like)? licen[sc]e", "bsd", "licen"),
    ("isc", 60, 1.0, f"{ISC_GRANT} provided that", "with or without fee", "provided that"),
    ("0bsd", 60, 1.0, f"{ISC_GRANT} the software is provided", "with or without fee", "the software is provided"),
    ("zlib", 60, 1.0, "this software is provided as is without any express or implied warranty in no event will the authors? be held "
     "liable", "without any express or implied warranty", "be held liable"),
    ("unlicense", 60, 1.0, "this is free and unencumbered software released into the public domain", "unencumbered", "public domain"),
    ("wtfpl", 60, 1.0, "everyone is permitted to copy and distribute verbatim or modified copies of this license document",
     "verbatim or modified", "license document"),
    ("cc0-1", 60, 1.0, "waived all copyright and related or neighboring rights", "waived all copyright", "neighboring rights"),
]


@dataclass(frozen=True)
class Signature:
    """A pattern with its place in the order; ``marker`` and one of ``names`` stand in every detection.

    The words of ``then`` follow the match, in order, before the pattern's next match.
    """

    label: str
    pattern: str
    priority: int
    confidence: float
    marker: str
    names: tuple[str, ...]
    then: tuple[str, ...] = ()


def _whole(pattern: str) -> str:
    return f"(?<![^ ]){pattern}(?![^ ])"


def _notices() -> list[Signature]:
    """Wordings of licence texts and notices, and versions that do not directly follow the name."""
    made = [Signature(label, _whole(pattern), priority, confidence, keyword, (second,), tuple(then))
            for label, priority, confidence, pattern, keyword, second, *then in WORDINGS]
    for label, name, number, words in VERSIONED:
        terms = r"(?: the terms(?: and conditions)? of)?(?: the)? "
        version = r"(?: either)? (?:version |v ?)?"
        made += [
            Signature(label, _whole(f"under{terms}{name}{AS_PUBLISHED}{version}{number}"), 42, 0.95, "under", words),
            Signature(label, _whole(f"subject to{terms}{name}{AS_PUBLISHED}{version}{number}"), 42, 0.95, "subject to", words),
            Signature(label, _whole(f"version {number} of the {name}"), 42, 0.95, "version", words),
            Signature(label, _whole(f"{name} version {number} (?:[12]9 )?(?:june|february|november) (?:1991|1999|2007)"), 60, 1.0,
                      "version", words)]
    for label, kind in CREATIVE_COMMONS:
        kind = f" {kind}" if kind else ""
        made.append(Signature(label, _whole(
            rf"creative commons attribution{kind}(?: [1-4] \d(?: [^ ]+){{0,2}})?(?: public)? licen[sc]e"), 48, 0.95, "creative commons", ("licen",)))
    return made


def signatures() -> list[Signature]:
    """Wordings of texts and notices, then every family in every form, strongest forms first."""
    return _notices() + [Signature(label, _whole(f"{before}{name}{after}"), priority, confidence, marker, names)
                         for priority, confidence, before, after, marker in FORMS for label, name, names in FAMILIES]


DETECTION = "struct<start:int,stop:int,level:int,rank:int,label:string,confidence:double>"
NONE = f"cast(array() as array<{DETECTION}>)"
OPEN, CLOSE = "\x01", "\x02"  # stand in no line: around the matches of a signature


def _followed(segment: Column, then: Column) -> Column:
    """Characters of ``segment`` to the end of the last words of ``then``; negative if they do not all follow."""
    spaced = F.concat(segment, F.lit(" "))

    def step(at: Column, words: Column) -> Column:
        found = F.nullif(F.position(F.concat(F.lit(" "), words, F.lit(" ")), spaced, at), F.lit(0))
        return F.coalesce(found + F.char_length(words) + 1, F.lit(0))

    return F.aggregate(then, F.lit(1), step) - 1


def _places(line: Column, rule: Column) -> Column:
    """The detections of one signature; the line is matched once."""
    marked = F.regexp_replace(line, rule["pattern"], F.lit(f"{OPEN}$0{CLOSE}"))

    def swept_pieces(pieces: Column) -> Column:  # between, match, between, match, ..., between
        def step(at: Column, i: Column) -> tuple[Column, Column]:
            start = at + F.char_length(F.get(pieces, 2 * i))
            stop = start + F.char_length(F.get(pieces, 2 * i + 1))
            more = _followed(F.get(pieces, 2 * i + 2), rule["then"])
            one = F.struct(start.alias("start"), (stop + more).alias("stop"), rule["level"].alias("level"),
                           rule["rank"].alias("rank"), rule["label"].alias("label"), rule["confidence"].alias("confidence"))
            return stop, F.when(more >= 0, one)

        return F.array_compact(swept(F.floor(F.size(pieces) / 2).cast("int"), F.lit(0), DETECTION, step))

    return bound(F.split(marked, f"[{OPEN}{CLOSE}]", -1), swept_pieces)


def _unsuppressed(found: Column, levels: int) -> Column:
    """The detections that no stronger one holds.

    ``level`` counts priorities from the greatest. In the order of start, then falling
    stop, then strength, whatever holds an interval stands before it, and is stronger
    unless its priority is less.
    """
    order = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"], (-d["stop"]).alias("back"), d["level"], d["rank"], d["stop"], d["label"], d["confidence"])))

    def swept_order(sorted_: Column) -> Column:
        def step(reach: Column, i: Column) -> tuple[Column, Column]:
            d = F.get(sorted_, i)
            now = F.transform(reach, lambda far, level: F.when(level >= d["level"], F.greatest(far, d["stop"])).otherwise(far))
            one = F.struct(*[d[c].alias(c) for c in ("start", "stop", "level", "rank", "label", "confidence")])
            return now, F.when(F.get(reach, d["level"]) < d["stop"], one)

        return F.array_compact(swept(F.size(sorted_), F.array_repeat(F.lit(0), levels), DETECTION, step))

    return bound(order, swept_order)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         rules: list[Signature] | None = None) -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    ``labels`` are arrays here; ``detections`` are the intervals left after suppression.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    rules = signatures() if rules is None else rules
    line = docs.select(F.col(id_col).alias(id_col), word_line(F.col(text_col)).alias("line"))

    base, firsts, lasts, named = F.lit(0).cast("long"), [], [], []
    for phrase, label in phrases.items():
        head, _, rest = phrase.partition(" ")
        tail = f"(?= {re.escape(rest)}(?![^ ]))" if rest else "(?![^ ])"
        pattern = f"(?<![^ ]){re.escape(head)}{tail}"
        held = F.contains("line", F.lit(phrase))
        pieces = F.when(held, F.split("line", pattern, -1))
        times = F.when(held, F.size(pieces).cast("long") - 1).otherwise(F.lit(0).cast("long"))
        base = base + times
        some = times > 0
        firsts.append(F.when(some, words_in(pieces[0])))
        lasts.append(F.when(some, F.col("n_words") - 1 - words_in(F.element_at(pieces, -1))))
        named.append(F.when(some, F.lit(label)))
    counted = line.withColumn("n_words", words_in(F.col("line")).cast("long")).select(
        "*", base.alias("n_base"), F.array_min(F.array(*firsts)).cast("long").alias("first_word"),
        F.array_max(F.array(*lasts)).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))).alias("base_labels"))

    levels = sorted({s.priority for s in rules}, reverse=True)
    table = F.array(*[F.struct(F.lit(s.label).alias("label"), F.lit(s.pattern).alias("pattern"),
                               F.lit(levels.index(s.priority)).alias("level"), F.lit(i).alias("rank"),
                               F.lit(s.confidence).alias("confidence"), F.lit(s.marker).alias("marker"),
                               F.array(*map(F.lit, s.names)).alias("names"),
                               F.array(*map(F.lit, s.then)).cast("array<string>").alias("then")) for i, s in enumerate(rules)])
    gated = F.filter(table, lambda s: F.contains("line", s["marker"]) & F.exists(
        s["names"], lambda name: F.contains("line", name)))
    found = F.flatten(F.transform(gated, lambda s: _places(F.col("line"), s)))
    marked = reduce(or_, [F.contains("line", F.lit(m)) for m in dict.fromkeys(s.marker for s in rules)], F.lit(False))
    seen = counted.withColumn("found", F.when(marked, found).otherwise(F.expr(NONE)))
    kept = F.when(F.size("found") > 1, _unsuppressed(F.col("found"), len(levels))).otherwise(F.col("found"))
    kept_rows = seen.withColumn("detections", kept)
    own = F.transform("detections", lambda d: d["label"])
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", own)))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best)
    return kept_rows.select(id_col, "n_words", "n_base", "first_word", "last_word", "base_labels",
                            labels.alias("labels"), score.alias("score"), "detections")
