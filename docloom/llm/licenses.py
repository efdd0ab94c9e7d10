r"""License scan: ordered signature rules on the words of a text, with built-in functions only.

A text's words are the runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z are lower-cased. Rules are regular
expressions over the words joined by single spaces. A rule runs only on texts that hold its keyword. Where the interval of one
detection lies in that of another, the rule with the better priority stays, and at the same priority the longer interval, so that
"gnu lesser general public license" is not also reported as the general one. Only the contract's base labels are exempt.

Defined results: a null text counts as empty; texts without any signature have score 0 and empty label strings; repeated
rows give repeated results; other columns are not read. All work is done inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases of the contract and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


class Rule(NamedTuple):
    """The keyword is one or more whole words that every match holds."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


# License names as label, keyword, pattern of the name in words.
NAMES = """
apache-2.0 ; apache ; apache (software )?license( version)? 2( 0)?
apache-1.1 ; apache ; apache (software )?license( version)? 1 1
apache ; apache ; apache (software )?license
mit ; mit license ; mit license
mit ; x11 license ; mit x11 license
mit-0 ; mit no attribution ; mit no attribution( license)?
bsd-2-clause ; bsd ; (2 clause|two clause|simplified|freebsd) bsd( license)?
bsd-2-clause ; bsd ; bsd (2 clause|two clause|simplified)( license)?
bsd-3-clause ; bsd ; (3 clause|three clause|new|modified|revised) bsd( license)?
bsd-3-clause ; bsd ; bsd (3 clause|three clause|new)( license)?
bsd-4-clause ; bsd ; (4 clause|original) bsd( license)?
bsd ; bsd ; bsd( style)? license
agpl-3.0 ; affero ; (gnu )?affero general public license( version)? 3( 0)?
agpl ; affero ; (gnu )?affero general public license
lgpl-2.1 ; lesser ; (gnu )?lesser general public license( version)? 2 1
lgpl-3.0 ; lesser ; (gnu )?lesser general public license( version)? 3( 0)?
lgpl ; lesser ; (gnu )?lesser general public license
lgpl-2.0 ; library general ; (gnu )?library general public license
gpl-2.0 ; general public ; (gnu )?general public license( version)? 2( 0)?
gpl-3.0 ; general public ; (gnu )?general public license( version)? 3( 0)?
gpl ; general public ; (gnu )?general public license
gfdl ; documentation ; (gnu )?free documentation license
mpl-1.1 ; mozilla ; mozilla public license( version)? 1 1
mpl-2.0 ; mozilla ; mozilla public license( version)? 2( 0)?
mpl ; mozilla ; mozilla public license
epl-1.0 ; eclipse public ; eclipse public license( version| v)? 1( 0)?
epl-2.0 ; eclipse ; eclipse public license( version| v)? 2( 0)?
epl ; eclipse ; eclipse public license
cddl ; distribution license ; common development and distribution license
cpl ; common ; common public license
eupl ; european ; european union public licen[cs]e
isc ; isc license ; isc license
zlib ; zlib ; zlib( libpng)? license
bsl-1.0 ; boost ; boost software license
artistic ; artistic license ; artistic license
unlicense ; unlicense ; (the )?unlicense
wtfpl ; wtfpl ; wtfpl
psf ; python software ; python software foundation license
php ; php license ; php license
ruby ; ruby license ; ruby license
perl ; terms as perl ; same terms as perl( itself)?
openssl ; openssl ; openssl license
postgresql ; postgresql ; postgresql license
ofl-1.1 ; font license ; (sil )?open font license
odbl ; database license ; open (data commons )?(open )?database license
cc0 ; cc0 ; cc0
cc0 ; commons zero ; creative commons zero
cc-by-nc-nd ; cc by ; cc by nc nd
cc-by-nc-sa ; cc by ; cc by nc sa
cc-by-nc ; cc by ; cc by nc
cc-by-nd ; cc by ; cc by nd
cc-by-sa ; cc by ; cc by sa
cc-by ; cc by ; cc by
cc-by-nc-nd ; creative commons ; creative commons attribution non ?commercial no ?deriv(s|atives)
cc-by-nc-sa ; creative commons ; creative commons attribution non ?commercial share ?alike
cc-by-nc ; creative commons ; creative commons attribution non ?commercial
cc-by-nd ; creative commons ; creative commons attribution no ?deriv(s|atives)
cc-by-sa ; creative commons ; creative commons attribution share ?alike
cc-by ; creative commons ; creative commons attribution
public-domain ; domain ; public domain
proprietary ; proprietary ; proprietary license
elastic-2.0 ; elastic license ; elastic license( version| v)? 2( 0)?
elastic ; elastic license ; elastic license
busl-1.1 ; business source ; business source license( version| v)? 1 1
busl ; business source ; business source license
sspl-1.0 ; server side public ; server side public license( version| v)?( 1( 0)?)?
ms-pl ; microsoft public ; microsoft public license
ms-rl ; microsoft reciprocal ; microsoft reciprocal license
ncsa ; illinois ; university of illinois( ncsa)?( open source)? license
upl-1.0 ; universal permissive ; universal permissive license
blueoak-1.0 ; blue oak ; blue oak model license
hpnd ; historical permission ; historical permission notice and disclaimer
afl ; academic free ; academic free license
osl ; open software ; open software license
apsl ; apple public ; apple public source license
ibm-public ; ibm public ; ibm public license
sun-public ; sun public ; sun public license
nokia ; nokia ; nokia open source license
cecill ; cecill ; cecill( free software)? licen[cs]e
lppl ; latex project ; latex project public license
vim ; vim license ; vim license
curl ; curl license ; curl license
libpng ; libpng license ; libpng license
ijg ; jpeg group ; independent jpeg group license
bzip2 ; bzip2 ; bzip2( libbzip2)? license
tcl ; tcl ; tcl( tk)? license
unicode ; unicode license ; unicode license( agreement)?
w3c ; w3c ; w3c software( and document)?( notice and)? license
zope ; zope public ; zope public license
cddl-1.0 ; development and distribution ; common development and distribution license( version)? 1 0
eupl-1.2 ; union public ; european union public licen[cs]e( version| v)? 1 2
artistic-2.0 ; artistic license ; artistic license( version)? 2( 0)?
polyform ; polyform ; polyform (noncommercial|small business|shield|strict|perimeter)( license)?
commons-clause ; commons clause ; commons clause
odc-by ; commons attribution ; open data commons attribution license
pddl ; public domain dedication ; (open data commons )?public domain dedication( and)? license
openrail ; rail ; (open )?rail( m)? license
llama ; community license ; llama( [0-9])?( [0-9])? community license
"""

# Short names as label, keyword, pattern; they count where something says that they are meant, and those of the second table anywhere.
SHORT_NAMES = """
mit ; mit ; mit
apache-2.0 ; apache ; apache 2( 0)?
apache ; apache ; apache
bsd ; bsd ; bsd
isc ; isc ; isc
gpl-2.0 ; gpl ; (gnu )?gpl( version)? 2( 0)?( only| or later| or any later version)?
gpl-3.0 ; gpl ; (gnu )?gpl( version)? 3( 0)?( only| or later| or any later version)?
gpl ; gpl ; (the )?(gnu )?gpl
lgpl-2.1 ; lgpl ; (gnu )?lgpl( version)? 2 1( only| or later)?
lgpl-3.0 ; lgpl ; (gnu )?lgpl( version)? 3( 0)?( only| or later)?
lgpl ; lgpl ; (the )?(gnu )?lgpl
agpl-3.0 ; agpl ; (gnu )?agpl( version)? 3( 0)?( only| or later)?
agpl ; agpl ; (the )?(gnu )?agpl
mpl-2.0 ; mpl ; mpl 2( 0)?
mpl ; mpl ; mpl
epl-2.0 ; epl ; epl 2( 0)?
epl ; epl ; epl
cddl ; cddl ; cddl
eupl ; eupl ; eupl
wtfpl ; wtfpl ; the wtfpl
ofl-1.1 ; ofl ; (sil )?ofl( 1 1)?
odbl ; odbl ; odbl
zlib ; zlib ; zlib
boost ; boost ; boost
sspl-1.0 ; sspl ; sspl( v?1)?
busl ; busl ; busl( 1 1)?
"""
PLAIN_NAMES = """
gpl-2.0 ; gplv2 ; gplv2( only| or later| or any later version)?
gpl-3.0 ; gplv3 ; gplv3( only| or later| or any later version)?
gpl-2.0 ; gpl v2 ; gpl v2( only| or later)?
gpl-3.0 ; gpl v3 ; gpl v3( only| or later)?
lgpl-2.1 ; lgplv2 ; lgplv2( 1)?( only| or later)?
lgpl-3.0 ; lgplv3 ; lgplv3( only| or later)?
lgpl ; lgpl ; (gnu )?lgpl
agpl-3.0 ; agplv3 ; agplv3( only| or later)?
agpl ; agpl ; (gnu )?agpl
gpl ; gnu gpl ; gnu gpl
mpl-2.0 ; mplv2 ; mplv2
apache-2.0 ; alv2 ; alv2
bsd-3-clause ; 3 clause ; bsd 3 clause
bsd-2-clause ; 2 clause ; bsd 2 clause
dual ; dual licensed ; dual licensed
"""

# What may stand before a name, as pattern, priority (smaller is better) and weight.
FRAMES = (
    (r"(licen[cs]ed|released|distributed|published|available|provided) under (the |an? )?(terms of (the )?)?({name})", 1, 0.95),
    (r"(use of this \w+ is governed by|subject to|under|license|licence) (the )?(terms (and conditions )?of (the )?)?({name})", 2, 0.9),
    (r"({name})", 3, 0.7),
)

# Signatures without a license name, as label, keyword, pattern, weight.
NOTICES = """
reserved ; reserved ; all rights reserved ; 0.8
reserved ; reserved ; (no|some) rights reserved ; 0.6
copyright ; copyright ; copyright( c)? (19|20)[0-9]{2}( (19|20)[0-9]{2})? ; 0.6
mit-text ; free of charge ; permission is hereby granted free of charge to any person obtaining a copy ; 0.95
isc-text ; permission ; permission to use copy modify and or distribute this software for any purpose ; 0.95
bsd-text ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted ; 0.95
warranty ; warranty ; without (any )?warranty ; 0.5
warranty ; warranties ; without (any )?warranties ; 0.5
warranty ; provided as is ; provided as is ; 0.5
gpl-text ; free software ; this program is free software you can redistribute it and or modify it ; 0.95
public-domain ; domain ; (dedicated|released) (in)?to the public domain ; 0.9
no-derivatives ; reproduced ; (may not|must not) be reproduced( in any form)? ; 0.6
confidential ; confidential ; proprietary and confidential ; 0.7
mit-text ; above copyright ; the above copyright notice and this permission notice shall be included in all copies or substantial portions ; 0.95
mit-text ; noninfringement ; merchantability fitness for a particular purpose and noninfringement ; 0.8
apache-text ; compliance ; you may not use this file except in compliance with the license ; 0.95
apache-text ; unless required ; unless required by applicable law or agreed to in writing ; 0.9
apache-text ; conditions of any kind ; without warranties or conditions of any kind( either express or implied)? ; 0.9
apache-text ; apache org licenses ; www apache org licenses license 2 0 ; 0.95
bsd-text ; redistributions ; redistributions of source code must retain the above copyright notice ; 0.95
bsd-text ; redistributions ; redistributions in binary form must reproduce the above copyright notice ; 0.95
bsd-3-text ; endorse ; may be used to endorse or promote products derived from this software ; 0.95
bsd-text ; consequential ; (direct )?indirect incidental special exemplary or consequential damages ; 0.8
bsd-4-text ; advertising ; all advertising materials mentioning features or use of this software ; 0.95
gpl-text ; any later ; either version [0-9] of the license or( at your option)? any later version ; 0.9
gpl-text ; hope that it will be useful ; in the hope that it will be useful but without any warranty ; 0.95
gpl-text ; merchantability ; implied warranty of merchantability or fitness for a particular purpose ; 0.8
gpl-text ; received a copy ; you should have received a copy of the gnu (lesser |affero |library )?general public license ; 0.95
gpl-text ; www gnu org licenses ; www gnu org licenses ; 0.9
gpl-text ; free software foundation ; published by the free software foundation ; 0.85
mpl-text ; source code form ; this source code form is subject to the terms of the mozilla public license ; 0.98
mpl-text ; mozilla org ; (http|https) mozilla org mpl 2 0 ; 0.95
epl-text ; accompanying materials ; this program and the accompanying materials are made available under the terms ; 0.9
isc-text ; disclaims all warranties ; the author disclaims all warranties with regard to this software ; 0.9
zlib-text ; misrepresented ; the origin of this software must not be misrepresented ; 0.95
zlib-text ; plainly marked ; altered source versions must be plainly marked as such ; 0.95
boost-text ; obtaining a copy ; to any person or organization obtaining a copy of the software ; 0.95
unlicense-text ; unencumbered ; this is free and unencumbered software released into the public domain ; 0.98
wtfpl-text ; do what the ; do what the (fuck|f ck) you want to ; 0.95
ofl-text ; font software ; the font software may be modified altered or added to ; 0.9
cc0-text ; waived ; waived all copyright and related or neighboring rights ; 0.95
cc-text ; creativecommons org ; creativecommons org licenses ; 0.9
cc-text ; copy and redistribute ; (free to )?copy and redistribute the material in any medium or format ; 0.85
cc-text ; remix ; remix transform and build upon the material ; 0.85
bsl-text ; www boost org ; www boost org license 1 0 txt ; 0.95
artistic-text ; standard version ; freely available in the standard version ; 0.7
public-domain ; copyright restrictions ; no known copyright restrictions ; 0.6
patent ; patent license ; grant of patent license ; 0.6
eula ; end user ; end user licen[cs]e agreement ; 0.7
eula ; by installing ; by installing( or)?( using)? (the|this) software you agree ; 0.8
proprietary ; trade secrets ; contains( confidential and)? proprietary( information)? and trade secrets ; 0.7
proprietary ; unauthorized ; unauthorized (copying|use|reproduction|distribution) of this (file|software|document) ; 0.8
proprietary ; prior written ; without( the)?( express)? prior written (permission|consent) ; 0.6
non-commercial ; commercial ; for non ?commercial (use|purposes)( only)? ; 0.6
non-commercial ; evaluation ; for evaluation purposes only ; 0.6
research ; research ; for research( use| purposes) only ; 0.6
copyright ; copyrighted ; copyrighted material ; 0.5
copyright ; copyright ; copyright c ; 0.4
trademark ; trademarks ; registered trademarks? of ; 0.4
redistribution ; redistributed ; may be( freely)? redistributed ; 0.5
permission ; with permission ; (reprinted|used|reproduced) with permission ; 0.5
"""


# SPDX ids as label, pattern of the id in words.
SPDX = """
apache-1.1 ; apache 1 1
apache-2.0 ; apache 2 0
mit ; mit
mit-0 ; mit 0
bsd-2-clause ; bsd 2 clause
bsd-3-clause ; bsd 3 clause
bsd-4-clause ; bsd 4 clause
agpl-3.0 ; agpl 3 0( only| or later)?
lgpl-2.0 ; lgpl 2 0( only| or later)?
lgpl-2.1 ; lgpl 2 1( only| or later)?
lgpl-3.0 ; lgpl 3 0( only| or later)?
gpl-2.0 ; gpl 2 0( only| or later)?
gpl-3.0 ; gpl 3 0( only| or later)?
gfdl ; gfdl 1 [123]( only| or later)?
mpl-1.1 ; mpl 1 1
mpl-2.0 ; mpl 2 0
epl-1.0 ; epl 1 0
epl-2.0 ; epl 2 0
cddl ; cddl 1 [01]
cpl ; cpl 1 0
eupl ; eupl 1 [012]
isc ; isc
zlib ; zlib
bsl-1.0 ; bsl 1 0
artistic ; artistic [12] 0
psf ; (psf|python) 2 0
php ; php 3 01?
ruby ; ruby
openssl ; openssl
postgresql ; postgresql
ofl-1.1 ; ofl 1 1
odbl ; odbl 1 0
cc0 ; cc0 1 0
0bsd ; 0bsd
elastic-2.0 ; elastic 2 0
busl-1.1 ; busl 1 1
sspl-1.0 ; sspl 1 0
ms-pl ; ms pl
ms-rl ; ms rl
ncsa ; ncsa
upl-1.0 ; upl 1 0
blueoak-1.0 ; blueoak 1 0 0
hpnd ; hpnd
afl ; afl [123] [012]
osl ; osl [123] [01]
apsl ; apsl [12] [012]
cecill ; cecill( b| c)?( 2 [01])?
lppl ; lppl 1 [0123]c?
vim ; vim
curl ; curl
libpng ; libpng( 2 0)?
ijg ; ijg
bzip2 ; bzip2 1 0 [56]
tcl ; tcl
unicode ; unicode (3 0|dfs 201[56])
w3c ; w3c( 20150513)?
zpl ; zpl [12] [01]
cc-by ; cc by [1234] 0
cc-by-sa ; cc by sa [1234] 0
cc-by-nc ; cc by nc [1234] 0
cc-by-nd ; cc by nd [1234] 0
cc-by-nc-sa ; cc by nc sa [1234] 0
cc-by-nc-nd ; cc by nc nd [1234] 0
odc-by ; odc by 1 0
pddl ; pddl 1 0
gpl-1.0 ; gpl 1 0( only| or later)?
mpl-1.0 ; mpl 1 0
apache-1.0 ; apache 1 0
x11 ; x11
unlicense ; unlicense
wtfpl ; wtfpl
"""


def rule_table() -> list[Rule]:
    """All signatures, best first: each name within each frame, short names within those that say that a license is meant, the SPDX ids, then the notices."""
    rules = []
    for line in NAMES.strip().splitlines():
        label, keyword, name = line.split(" ; ")
        rules += [Rule(label, keyword, frame.replace("{name}", name), priority, weight) for frame, priority, weight in FRAMES]
    for table, frames in ((SHORT_NAMES, FRAMES[:2]), (PLAIN_NAMES, FRAMES[-1:])):
        for line in table.strip().splitlines():
            label, keyword, name = line.split(" ; ")
            rules += [Rule(label, keyword, frame.replace("{name}", name), priority, weight) for frame, priority, weight in frames]
    for line in SPDX.strip().splitlines():
        label, name = line.split(" ; ")
        rules.append(Rule(label, "spdx license identifier", f"spdx license identifier {name}", 1, 0.99))
    for line in NOTICES.strip().splitlines():
        label, keyword, pattern, weight = line.split(" ; ")
        rules.append(Rule(label, keyword, pattern, 3, float(weight)))
    return sorted(rules, key=lambda r: (r.priority, -len(r.pattern), r.pattern))


def words_joined(text: Column) -> Column:
    """The words of a text, as they are written, joined by single spaces."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))


def phrase_starts(tokens: Column, phrase: str) -> Column:
    """Indexes of the words at which the phrase begins."""
    want = phrase.split()
    at = F.sequence(F.lit(0), F.size(tokens) - len(want))
    fits = lambda i: F.forall(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in enumerate(want)]), lambda s: F.get(tokens, i + s["k"]) == s["w"])
    return F.when(F.size(tokens) >= len(want), F.filter(at, lambda i: (F.get(tokens, i) == want[0]) & fits(i))).otherwise(F.array().cast("array<int>"))


def _detections(joined: Column, rules: Sequence[Rule]) -> Column:
    """All places of all rules whose keyword occurs, as structs (start, -end, priority, order, label, weight)."""
    by_keyword: dict[str, list[Column]] = {}
    for i, r in enumerate(rules):
        fields = (("pattern", f"(?<= ){r.pattern}(?= )"), ("priority", r.priority), ("order", i), ("label", r.label), ("weight", r.weight))
        by_keyword.setdefault(f" {r.keyword} ", []).append(F.struct(*[F.lit(v).alias(k) for k, v in fields]))
    table = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*own).alias("rules")) for k, own in by_keyword.items()])
    live = F.flatten(F.transform(F.filter(table, lambda k: joined.contains(k["keyword"])), lambda k: k["rules"]))

    fields = ("pattern", "priority", "order", "label", "weight")
    tried = F.transform(live, lambda r: F.struct(*[r[k].alias(k) for k in fields], F.regexp_extract_all(joined, r["pattern"], F.lit(0)).alias("found")))
    hits = F.filter(tried, lambda r: F.size(r["found"]) > 0)
    cut = F.transform(hits, lambda r: F.struct(*[r[k].alias(k) for k in (*fields, "found")], F.split(joined, r["pattern"]).alias("gaps")))

    def places(r: Column) -> Column:
        sizes = F.zip_with(F.slice(r["gaps"], 1, F.size(r["found"])), r["found"], lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")))
        empty = F.array().cast("array<struct<start:int,less_end:int,priority:int,order:int,label:string,weight:double>>")

        def add(acc: Column, s: Column) -> Column:
            begin = acc["at"] + s["gap"]
            end = begin + s["hit"]
            one = F.struct(begin.alias("start"), (-end).alias("less_end"), r["priority"].alias("priority"), r["order"].alias("order"), r["label"].alias("label"), r["weight"].alias("weight"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(sizes, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda acc: acc["out"])

    return F.array_sort(F.flatten(F.transform(cut, places)))


def _surviving(detections: Column) -> Column:
    """Labels and weights of detections that no earlier one of the same or a better priority contains.

    Detections come sorted by start, then longest first. So one is contained in an earlier one of priority p
    exactly if the largest end so far at p reaches its own end; later ones with the same start and end have a worse or equal priority.
    """
    start = F.struct(F.lit(0).alias("e1"), F.lit(0).alias("e2"), F.lit(0).alias("e3"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("best"), F.lit(1.0).alias("miss"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["less_end"]
        reach = F.when(d["priority"] == 1, acc["e1"]).when(d["priority"] == 2, F.greatest(acc["e1"], acc["e2"])).otherwise(F.greatest(acc["e1"], acc["e2"], acc["e3"]))
        stays = reach < end
        new = stays & ~F.array_contains(acc["labels"], d["label"])
        return F.struct(
            F.when(d["priority"] == 1, F.greatest(acc["e1"], end)).otherwise(acc["e1"]).alias("e1"),
            F.when(d["priority"] == 2, F.greatest(acc["e2"], end)).otherwise(acc["e2"]).alias("e2"),
            F.when(d["priority"] == 3, F.greatest(acc["e3"], end)).otherwise(acc["e3"]).alias("e3"),
            F.when(new, F.concat(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.greatest(acc["best"], d["weight"]).alias("best"),
            F.when(new, acc["miss"] * (F.lit(1.0) - d["weight"])).otherwise(acc["miss"]).alias("miss"),
        )

    return F.aggregate(detections, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), (F.lit(1.0) - acc["miss"]).alias("score")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    score is one less the product of (1 - weight) over the distinct labels that the rules found.
    """
    rules = rule_table() if rules is None else rules
    triggers = sorted({max(k.split(), key=len) for k in [r.keyword for r in rules] + [phrase for phrase, _ in BASE]})
    joined = docs.select(F.col(id_col), words_joined(F.col(text_col)).alias("cased"))
    # lower() also folds other letters, so that this gate lets through all texts that the exact mapping below can match
    split = joined.withColumn("words", F.split(F.lower("cased"), " "))
    counted = split.withColumn("n_words", F.when(F.col("cased") == "", F.lit(0)).otherwise(F.size("words")).cast("long"))
    gated = counted.withColumn("joined", F.when(F.arrays_overlap("words", F.array(*map(F.lit, triggers))), F.concat(F.lit(" "), F.translate("cased", UPPER, LOWER), F.lit(" "))))
    gated = gated.withColumn("tokens", F.split(F.trim("joined"), " "))  # a column, so that lambdas below don't split anew for each word
    tokens = F.col("tokens")
    hits = [F.when(F.contains(F.col("joined"), F.lit(f" {phrase} ")), phrase_starts(tokens, phrase)).otherwise(F.array().cast("array<int>")) for phrase, _ in BASE]
    found = gated.withColumn("starts", F.when(F.col("joined").isNotNull(), F.array(*hits)))
    scanned = found.withColumn("seen", F.when(F.col("joined").isNotNull(), _surviving(_detections(F.col("joined"), rules))))
    base = F.coalesce(F.filter(F.array(*[F.when(F.size(F.get("starts", i)) > 0, label) for i, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull()), F.array().cast("array<string>"))
    flat = F.flatten("starts")
    return scanned.select(
        id_col,
        "n_words",
        F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.size(flat)).cast("long").alias("n_base"),
        F.array_min(flat).cast("long").alias("first_word"),
        F.array_max(flat).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce(F.col("seen.labels"), F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce(F.col("seen.score"), F.lit(0.0)).alias("score"),
    )
