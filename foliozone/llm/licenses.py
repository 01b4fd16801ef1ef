"""License scans by ordered signature rules.

Some hundred licenses and versions, each stated once with its name, and a handful of ways to cite
one (identifier tag, grant, name with "license", address) give several hundred regex rules; notices
that name no license have rules of their own. A rule runs only on texts that hold one of its keywords.

A space of a rule stands for any run of ASCII characters that are no word's, as in the base phrases:
line ends, indents, comment marks, quotes. Where a rule may do without the separator ("gpl2"), only
a space, a hyphen or a line end with its indent and comment marks may stand there, so that "GPL, 2
files" is no version. Keywords are sought in the text with such runs made one space.

Every match is a detection (rule, first, end). A detection whose interval lies inside another's of
the same or a higher priority is dropped, of equal intervals the first rule's stays, and of two that
cross, the one of lower priority. The labels left are the text's, with those of the base phrases;
the score is the confidence of the best rule, 0 without any.

Null and empty texts have no words and no labels. Repeated rows get equal results, one each. All
work is in expressions over single rows, without exchange; the whole path is DataFrame operations.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.llm.native import indices, let, matches, no_nulls, running

# Word characters of the contract: digits, ASCII letters, everything beyond ASCII.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: What may stand where a rule needs no separator: blanks, or a line end with indent and comment marks.
_LAYOUT = r"(?:-|[ \t]*[\r\n]\s*(?:[/*#;%!>|\"'-]+\s*)?|[ \t]+)?"

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keyword (or several, any of which will do), regex of the name; ``{v}`` takes the versions that follow.
FAMILIES = [
    ("mit", "mit", r"(?:mit|expat|x11)", ()),
    ("mit-0", "mit-0", r"mit-0", ()),
    ("mit-0", "attribution", r"mit[ -]no[ -]attribution", ()),
    ("apache-{v}", "apache", r"apache(?: software)?(?: license|-)?,?[ -]?(?:version |v\.? ?)?{v}(?:\.0)?", ("1", "1.1", "2")),
    ("bsd-{v}-clause", "bsd", r"(?:(?:{v}|{w})[ -]clause bsd|bsd[ -]{v}[ -]clause)", ("0", "1", "2", "3", "4")),
    ("gpl-{v}", "gpl", r"(?:gnu )?gpl[ -]?(?:version |v\.? ?)?{v}(?:\.0)?(?:-only|-or-later|\+)?", ("1", "2", "3")),
    ("gpl-{v}", "gnu general public", r"gnu general public licen[cs]e,? (?:as published by the free software foundation[;,]? (?:either )?)?(?:version |v\.? ?){v}(?:\.0)?", ("1", "2", "3")),
    ("lgpl-{v}", "lgpl", r"(?:gnu )?lgpl[ -]?(?:version |v\.? ?)?{v}(?:\.0)?(?:-only|-or-later|\+)?", ("2", "2.1", "3")),
    ("lgpl-{v}", "gnu l", r"gnu (?:lesser|library) general public licen[cs]e,? (?:version |v\.? ?){v}(?:\.0)?", ("2", "2.1", "3")),
    ("agpl-{v}", "agpl", r"(?:gnu )?agpl[ -]?(?:version |v\.? ?)?{v}(?:\.0)?(?:-only|-or-later|\+)?", ("1", "3")),
    ("agpl-{v}", "gnu affero", r"gnu affero general public licen[cs]e,? (?:version |v\.? ?){v}(?:\.0)?", ("1", "3")),
    ("gfdl-{v}", "free documentation", r"gnu free documentation licen[cs]e,? (?:version |v\.? ?){v}", ("1.1", "1.2", "1.3")),
    ("mpl-{v}", "mozilla public", r"mozilla public licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1", "2.0")),
    ("mpl-{v}", "mpl |mpl-|mpl1|mpl2", r"mpl[ -]?(?:version |v\.? ?)?{v}", ("1.0", "1.1", "2.0")),
    ("epl-{v}", "eclipse public", r"eclipse public licen[cs]e,? (?:version |v\.? ?|- v ?)?{v}", ("1.0", "2.0")),
    ("epl-{v}", "epl |epl-|epl1|epl2", r"epl[ -]?(?:version |v\.? ?)?{v}", ("1.0", "2.0")),
    ("cddl-{v}", "common development", r"common development and distribution licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1")),
    ("cddl-{v}", "cddl", r"cddl[ -]?(?:version |v\.? ?)?{v}", ("1.0", "1.1")),
    ("cpl-{v}", "common public", r"common public licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0",)),
    ("eupl-{v}", "european union public", r"european union public licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1", "1.2")),
    ("eupl-{v}", "eupl", r"eupl[ -]?(?:version |v\.? ?)?{v}", ("1.0", "1.1", "1.2")),
    ("osl-{v}", "open software", r"open software licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "2.0", "2.1", "3.0")),
    ("afl-{v}", "academic free", r"academic free licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.1", "2.0", "2.1", "3.0")),
    ("ms-pl", "microsoft", r"microsoft public", ()),
    ("ms-rl", "microsoft", r"microsoft reciprocal", ()),
    ("artistic-{v}", "artistic", r"(?:the )?artistic licen[cs]e,? (?:version |v\.? ?)?{v}(?:\.0)?", ("1", "2")),
    ("lppl-{v}", "latex", r"latex project public licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1", "1.2", "1.3")),
    ("ofl-{v}", "open font", r"(?:sil )?open font licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1")),
    ("bsl-{v}", "boost", r"boost software licen[cs]e,? -?(?: ?version |v\.? ?)?{v}", ("1.0",)),
    ("busl-{v}", "business source", r"business source licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0", "1.1")),
    ("sspl-{v}", "server side public", r"server side public licen[cs]e,? (?:version |v\.? ?)?{v}", ("1",)),
    ("elastic-{v}", "elastic", r"elastic licen[cs]e,? (?:version |v\.? ?)?{v}(?:\.0)?", ("1", "2")),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?:/libpng)?", ()),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtf", r"wtfpl|do what the fuck you want to public", ()),
    ("psf-{v}", "python", r"python(?: software foundation)? licen[cs]e,? (?:version |v\.? ?)?{v}", ("2",)),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("openssl", "openssl", r"openssl", ()),
    ("php-{v}", "php", r"php licen[cs]e,? (?:version |v\.? ?)?{v}", ("3.0", "3.01")),
    ("ruby", "ruby", r"ruby", ()),
    ("vim", "vim", r"vim", ()),
    ("beerware", "beer", r"beer-?ware", ()),
    ("json", "json", r"json", ()),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", ()),
    ("w3c", "w3c", r"w3c(?: software)?", ()),
    ("upl-{v}", "universal permissive", r"universal permissive licen[cs]e,? (?:version |v\.? ?)?{v}", ("1.0",)),
    ("cc-by-{v}", "cc by|cc-by", r"cc[ -]by[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa-{v}", "cc by|cc-by", r"cc[ -]by[ -]sa[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd-{v}", "cc by|cc-by", r"cc[ -]by[ -]nd[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-{v}", "cc by|cc-by", r"cc[ -]by[ -]nc[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa-{v}", "cc by|cc-by", r"cc[ -]by[ -]nc[ -]sa[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd-{v}", "cc by|cc-by", r"cc[ -]by[ -]nc[ -]nd[ -]{v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-{v}", "creative commons", r"creative commons attribution(?: \d)?,? {v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa-{v}", "creative commons", r"creative commons attribution[ -]share-?alike {v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd-{v}", "creative commons", r"creative commons attribution[ -]no-?deriv(?:ative)?s {v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-{v}", "creative commons", r"creative commons attribution[ -]non-?commercial {v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa-{v}", "creative commons", r"creative commons attribution[ -]non-?commercial[ -]share-?alike {v}", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?:[ -]1\.0)?(?: universal)?", ()),
    ("odbl", "open database", r"open database", ()),
    ("odc-by", "open data commons", r"open data commons attribution", ()),
]

#: way, regex around the name, priority, confidence; a name that holds "license" fits them all.
WAYS = [
    ("tag", r"spdx-license-identifier:\s*(?:{name})", 90, 1.0),
    ("grant", r"(?:licen[cs]ed|released|distributed|available|published|used) under (?:the )?(?:terms of (?:the )?)?(?:{name})", 80, 0.95),
    ("field", r"licen[cs]e\s*[:=]\s*[\"']?(?:{name})", 70, 0.9),
    ("name", r"(?:{name})[ -](?:public )?licen[cs]e", 60, 0.8),
    ("mention", r"(?:{name})", 40, 0.6),
]

#: label, keyword, regex, priority, confidence: notices and addresses.
NOTICES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy", 85, 0.95),
    ("isc", "permission to use, copy", r"permission to use, copy, modify,? and/or distribute this software for any purpose", 85, 0.95),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms, with or without modification", 75, 0.85),
    ("gpl", "free software", r"is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e", 75, 0.85),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 85, 0.95),
    ("public-domain", "public domain", r"(?:released into|dedicated to|placed in(?:to)?) the public domain", 50, 0.7),
    ("proprietary", "all rights reserved", r"all rights reserved", 20, 0.3),
    ("apache-2", "apache.org/licenses", r"https?://(?:www\.)?apache\.org/licenses/license-2\.0", 85, 0.95),
    ("gpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl", 75, 0.85),
    ("lgpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl", 75, 0.85),
    ("agpl", "gnu.org/licenses", r"https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?agpl", 75, 0.85),
    ("mit", "opensource.org/licenses", r"https?://(?:www\.)?opensource\.org/licenses/mit", 85, 0.95),
    ("mpl-2.0", "mozilla.org/mpl", r"https?://(?:www\.)?mozilla\.org/(?:en-us/)?mpl/2\.0", 85, 0.95),
    ("cc-by", "creativecommons.org", r"https?://creativecommons\.org/licenses/by/", 85, 0.9),
    ("cc-by-sa", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-sa/", 85, 0.9),
    ("cc-by-nd", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nd/", 85, 0.9),
    ("cc-by-nc", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nc/", 85, 0.9),
    ("cc-by-nc-sa", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nc-sa/", 85, 0.9),
    ("cc-by-nc-nd", "creativecommons.org", r"https?://creativecommons\.org/licenses/by-nc-nd/", 85, 0.9),
    ("cc0-1.0", "creativecommons.org", r"https?://creativecommons\.org/publicdomain/zero/", 85, 0.9),
    ("cc-by", "creative commons", r"creative commons attribution licen[cs]e", 55, 0.8),
    ("cc-by-nc", "cc by|cc-by", r"cc[ -]by[ -]nc", 45, 0.7),
    ("cc-by-sa", "cc by|cc-by", r"cc[ -]by[ -]sa", 45, 0.7),
    ("cc-by", "cc by|cc-by", r"cc[ -]by", 35, 0.6),
    ("gpl", "gnu general public", r"gnu general public licen[cs]e", 50, 0.75),
    ("lgpl", "gnu lesser general public", r"gnu lesser general public licen[cs]e", 50, 0.75),
    ("agpl", "gnu affero general public", r"gnu affero general public licen[cs]e", 50, 0.75),
    ("artistic", "artistic license", r"(?:the )?artistic licen[cs]e", 45, 0.7),
    ("sspl-1", "server side public", r"server side public licen[cs]e", 50, 0.75),
]

#: Names that are ordinary words count only where the way itself speaks of a license.
_COMMON = {"mit", "isc", "ruby", "vim", "json", "zlib", "w3c", "postgresql", "openssl", "ms-pl", "ms-rl"}

_SPELLED = {"0": "zero", "1": "one", "2": "two", "3": "three", "4": "four"}


def _spaced(regex: str) -> str:
    """The regex with its spaces widened: ``[ -]?`` and `` ?`` to what layout puts there, others to any gap."""
    parts = {"[ -]?": _LAYOUT, " ?": _LAYOUT, "[ -]": _GAP, " ": _GAP}
    return re.sub(r"\[ -\]\??| \??", lambda m: parts[m[0]], regex)


def _even(text: Column) -> Column:
    """Lower case, gaps made one space, one at either end."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), _GAP, " "), F.lit(" "))


def rules() -> list[dict]:
    """All rules in order: priority first, then as stated above."""
    out = []
    for label, keyword, name, versions in FAMILIES:
        for v in versions or ("",):
            full = name.replace("{v}", re.escape(v)).replace("{w}", _SPELLED.get(v, v))
            if v and "." not in v:
                full += r"(?![.\d]*[1-9])" if not full.endswith("clause)") else ""
            for way, around, priority, confidence in WAYS:
                if way == "mention" and label in _COMMON:
                    continue
                gate = keyword if way == "mention" or len(keyword) > 3 else "licen" if way in ("tag", "field", "name") else " under "
                regex = rf"(?i)(?<![0-9a-z]){_spaced(around.replace('{name}', full))}(?![0-9a-z])"
                out.append({"label": label.replace("{v}", v), "keywords": gate.split("|"), "regex": regex, "priority": priority, "score": confidence})
    for label, keyword, regex, priority, confidence in NOTICES:
        out.append({"label": label, "keywords": keyword.split("|"), "regex": rf"(?i)(?<![0-9a-z]){_spaced(regex)}", "priority": priority, "score": confidence})
    out.sort(key=lambda r: -r["priority"])
    return [r | {"rank": k} for k, r in enumerate(out)]


def keywords(all_rules: list[dict]) -> list[str]:
    return sorted({k for r in all_rules for k in r["keywords"]})


_SCHEMA = "array<struct<label:string,keywords:array<string>,regex:string,priority:int,score:double,rank:int>>"
_NONE = "array<struct<first:int,end:int,rank:int,label:string,priority:int,score:double>>"


def detections(text: Column, all_rules: list[dict] | None = None) -> Column:
    """The detections of a text that no other suppresses, as an array of structs."""
    all_rules = rules() if all_rules is None else all_rules
    table = F.from_json(F.lit(json.dumps(all_rules)), _SCHEMA)

    def found(held: Column) -> Column:
        used = F.filter(table, lambda r: F.arrays_overlap(held, r["keywords"]))
        return F.flatten(
            F.transform(
                used,
                lambda r: F.transform(
                    F.when(F.regexp_like(text, r["regex"]), matches(text, r["regex"])).otherwise(F.array().cast("array<struct<first:int,end:int,found:string>>")),
                    lambda m: F.struct(m["first"].alias("first"), m["end"].alias("end"), r["rank"].alias("rank"), r["label"].alias("label"), r["priority"].alias("priority"), r["score"].alias("score")),
                ),
            )
        )

    def loses(d: Column, o: Column) -> Column:
        inside = (o["first"] <= d["first"]) & (d["end"] <= o["end"])
        equal = (o["first"] == d["first"]) & (d["end"] == o["end"])
        meets = (o["first"] < d["end"]) & (d["first"] < o["end"])
        return (inside & ~equal & (o["priority"] >= d["priority"])) | (equal & (o["rank"] < d["rank"])) | (meets & (o["priority"] > d["priority"]))

    def left(spans: Column) -> Column:
        """In order of their starts, detections meet only within runs that nothing before reaches into."""
        reached = running(F.transform(spans, lambda d: d["end"]), F.greatest)
        starts = let(reached, lambda r: F.filter(indices(F.size(spans)), lambda i: (i == 0) | (F.get(spans, i)["first"] >= F.get(r, i - 1))))
        of_run = lambda run: F.filter(run, lambda d: ~F.exists(run, lambda o: loses(d, o)))
        return let(starts, lambda at: F.flatten(F.transform(at, lambda a, k: let(F.slice(spans, a + 1, F.coalesce(F.get(at, k + 1), F.size(spans)) - a), of_run))))

    def judged(held: Column) -> Column:
        kept = let(F.array_sort(found(held)), left)
        return F.when(F.size(held) > 0, kept).otherwise(F.array().cast(_NONE))

    # a plain search for each keyword, which costs far less than one regex of them all
    known = F.from_json(F.lit(json.dumps([{"k": k, "even": re.sub(_GAP, " ", k)} for k in keywords(all_rules)])), "array<struct<k:string,even:string>>")
    held = let(_even(text), lambda low: F.transform(F.filter(known, lambda k: F.contains(low, k["even"])), lambda k: k["k"]))
    return let(held, judged)


def _phrase(words: str) -> str:
    return _GAP.join(words.split())


def scan(docs: DataFrame) -> DataFrame:
    """A row for every row of ``docs``: places of base phrases, labels of all rules, score, detections."""
    anywhere = rf"(?i)(?<!{_WORD})(?:{'|'.join(map(_phrase, BASE))})(?!{_WORD})"
    n_words = lambda t: F.regexp_count(t, F.lit(f"{_WORD}+"))
    text = no_nulls()
    base = F.when(F.regexp_like(text, F.lit(anywhere)), F.struct(F.split(text, anywhere, -1).alias("between"), F.regexp_extract_all(text, F.lit(anywhere), F.lit(0)).alias("found")))
    rows = docs.select("doc_id", n_words(text).cast("bigint").alias("n_words"), base.alias("b"), detections(text).alias("detections"))
    held = lambda phrase: F.exists("b.found", lambda m: F.regexp_like(m, F.lit(f"(?i)^{_phrase(phrase)}$")))
    labels = F.filter(F.array(*(F.when(held(phrase), F.lit(label)) for phrase, label in BASE.items())), lambda x: x.isNotNull())
    labels = F.coalesce(labels, F.array().cast("array<string>"))
    last = F.element_at("b.found", -1)
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("b.found"), F.lit(0)).cast("bigint").alias("n_base"),
        F.when(F.col("b").isNotNull(), n_words(F.element_at("b.between", 1))).cast("bigint").alias("first_word"),
        F.when(F.col("b").isNotNull(), F.col("n_words") - n_words(F.element_at("b.between", -1)) - n_words(last)).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.col("detections.label"))), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max("detections.score"), F.lit(0.0)), F.when(F.col("b").isNotNull(), F.lit(0.8)).otherwise(F.lit(0.0))).alias("score"),
        "detections",
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.drop("detections")
