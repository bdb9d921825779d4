"""Licence scan by sentence rules: normalised sentences become identifiers, identifier sequences meet ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

#: Normalised sentences (lower case, numbers as #, other characters as one space; ``*`` stands for a name
#: of up to ten words) of the licences' notices and titles, and the identifiers that they map to.
SENTENCES = {
    "licensed under the apache license version #": "apache-line",
    "licensed under the apache license version # the license": "apache-line",
    "the asf licenses this file to you under the apache license version # the license": "apache-line",
    "apache license version # january #": "apache-title",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "you may obtain a copy of the license at http www apache org licenses license #": "apache-copy",
    "you may obtain a copy of the license at https www apache org licenses license #": "apache-copy",
    "released under the mit license": "mit-line",
    "licensed under the mit license": "mit-line",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so": "mit-0-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "as-is",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement": "as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "zero-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advertising",
    "neither the name of * nor the names of its contributors may be used to endorse or promote products": "bsd-names",
    "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this program is free software": "free",
    "this library is free software": "free",
    "either version # of the license or at your option any later version": "or-later",
    "either version # or at your option any later version": "or-later",
    "version # of the license": "version-of",
    "this source code form is subject to the terms of the mozilla public license v #": "mpl-line",
    "this source code form is subject to the terms of the mozilla public license version #": "mpl-line",
    "mozilla public license version #": "mpl-title",
    "to the extent possible under law * has waived all copyright and related or neighboring rights to *": "cc-zero-waiver",
    "cc# # universal": "cc-zero-title",
    "the artistic license": "artistic-title",
    "the artistic license #": "artistic-version",
    "artistic license #": "artistic-version",
    "python software foundation license version #": "psf-title",
    "this program bzip# the associated library libbzip# and all documentation are copyright c # # julian r seward": "bzip-title",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "the origin of this software must not be misrepresented": "origin",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "altered",
    "this notice may not be removed or altered from any source distribution": "zlib-notice",
    "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version # or any later version published by the free software foundation": "gfdl-later",
    **{f"gnu free documentation license version # {m}": "gfdl-title" for m in ("march #", "november #", "# november #")},
}
#: The GNU licences' names in text, and the months that their titles end with.
GNU = {"AGPL": ["gnu affero general public license"], "LGPL": ["gnu lesser general public license", "gnu library general public license"], "GPL": ["gnu general public license"]}
_MONTHS = ("# june #", "june #", "# november #", "february #")
_TERMS = "you can redistribute it and or modify it under the terms of the "
for _id, _text in [(name.lower(), text) for name, texts in GNU.items() for text in texts]:
    SENTENCES |= {
        f"this work is licensed under the {_text} version #": f"{_id}-line",
        f"{_TERMS}{_text}": f"{_id}-terms",
        f"{_TERMS}{_text} as published by the free software foundation": f"{_id}-terms",
        f"{_TERMS}{_text} as published by the free software foundation either version # of the license or at your option any later version": f"{_id}-later",
        f"{_TERMS}{_text} as published by the free software foundation either version # or at your option any later version": f"{_id}-later",
        f"{_TERMS}{_text} as published by the free software foundation version # of the license": f"{_id}-version",
        f"{_TERMS}{_text} version # as published by the free software foundation": f"{_id}-version",
        **{f"{_text} version # {m}": f"{_id}-title" for m in _MONTHS},
    }
#: Creative Commons licences' conditions by their short forms.
CREATIVE = {"by-nc-sa": "attribution noncommercial sharealike", "by-nc-nd": "attribution noncommercial noderivatives", "by-nc": "attribution noncommercial", "by-sa": "attribution sharealike", "by-nd": "attribution noderivatives", "by": "attribution"}
for _id, _text in CREATIVE.items():
    SENTENCES |= {
        f"licensed under cc {_id.replace('-', ' ')} #": f"cc-{_id}-line",
        f"this work is licensed under a creative commons {_text} # international license": f"cc-{_id}-line",
        f"this work is licensed under the creative commons {_text} # international license": f"cc-{_id}-line",
    }
#: Licence identifiers that a line may state after ``SPDX-License-Identifier:``; # stands for a version.
SPDX = [
    "MIT", "MIT-#", "ISC", "Unlicense", "Zlib", "Artistic-#", "PSF-#", "Apache-#", "BSD-#-Clause", "MPL-#", *[f"{g}-#{e}" for g in (*GNU, "GFDL") for e in ("-only", "-or-later", "")], *[f"CC-{c.upper()}-#" for c in CREATIVE],
]
SENTENCES |= {f"spdx {x.lower().replace('-', ' ')}": f"spdx-{x.lower().replace('#', 'n')}" for x in SPDX}
#: In order, each rule consumes the identifiers that it matches: (licence, with # for the version,
#: identifiers that follow each other, which of them states the version).
RULES = [
    *[(x, [f"spdx-{x.lower().replace('#', 'n')}"], 0) for x in SPDX],
    ("Apache-#", ["apache-line", "apache-use", "apache-copy"], 0),
    ("Apache-#", ["apache-line"], 0),
    ("Apache-#", ["apache-title"], 0),
    ("MIT", ["mit-grant", "mit-notice", "as-is"], None),
    ("MIT", ["mit-grant", "mit-notice"], None),
    ("MIT-0", ["mit-0-grant"], None),
    ("MIT", ["mit-line"], None),
    ("ISC", ["isc-grant"], None),
    ("0BSD", ["zero-grant"], None),
    ("Unlicense", ["unlicense"], None),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"], None),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"], None),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], None),
    ("bzip2", ["bzip-title", "bsd-grant", "bsd-source", "origin", "altered"], None),
    ("bzip2", ["bsd-grant", "bsd-source", "origin", "altered"], None),
    ("Zlib", ["zlib-grant", "origin", "altered", "zlib-notice"], None),
    ("Artistic", ["artistic-title"], None),
    ("Artistic-#", ["artistic-version"], 0),
    ("PSF-#", ["psf-title"], 0),
    ("GFDL-#-or-later", ["gfdl-later"], 0),
    ("GFDL-#", ["gfdl-title"], 0),
]
for _name in GNU:
    _id = _name.lower()
    for _free in (["free"], []):
        RULES += [
            (f"{_name}-#-or-later", [*_free, f"{_id}-later"], len(_free)),
            (f"{_name}-#-or-later", [*_free, f"{_id}-terms", "or-later"], len(_free) + 1),
            (f"{_name}-#", [*_free, f"{_id}-version"], len(_free)),
            (f"{_name}-#", [*_free, f"{_id}-terms", "version-of"], len(_free) + 1),
            (_name, [*_free, f"{_id}-terms"], None),
        ]
    RULES += [(f"{_name}-#", [f"{_id}-line"], 0), (f"{_name}-#", [f"{_id}-title"], 0)]
RULES += [(f"CC-{_id.upper()}-#", [f"cc-{_id}-line"], 0) for _id in CREATIVE]
RULES += [("CC0", ["cc-zero-waiver"], None), ("CC0", ["cc-zero-title"], None), ("MPL-#", ["mpl-line"], 0), ("MPL-#", ["mpl-title"], 0)]
#: A text without one of these has none of SENTENCES; it saves normalising all other texts.
CUE = "(?i)licen[sc]|copyright|permi|redistribut|software|cc by|cc-by|cc0|spdx"
END = r"[.!?;:]+(\s|$)"
SPDX_LINE = r"spdx-license-identifier:[ \t]*\(?([a-z0-9.+-]+)(?: (?:or|and) ([a-z0-9.+-]+))?\)?"
#: A normalised text's number and name; its words are parted by a space or, where a line ends, by ``~``.
_PART = {"#": "[0-9]+(?:_[0-9]+)*", "*": "[a-z0-9_]+(?:[ ~|][a-z0-9_]+){0,9}?[|]?"}
#: The known sentences, longest first, so that a line that ends within one cuts nothing off it.
_KNOWN = "|".join("[ ~]".join(_PART.get(w, w.replace("#", "[0-9]+")) for w in k.split()).replace("[|]?[ ~]", "[ ~|]") for k in sorted(SENTENCES, key=len, reverse=True))
#: What a name stands in for is cut out of a sentence before it is looked up.
_NAMES = (("^neither the name of .+? nor ", "neither the name of * nor "), ("^to the extent possible under law .+? has waived ", "to the extent possible under law * has waived "), (" neighboring rights to .+$", " neighboring rights to *"))


def _marked(text: Column) -> Column:
    """Words and numbers (``2_0`` for 2.0) of a text in lower case, ``|`` between sentences and paragraphs and ``~``
    where another line of a paragraph begins."""
    t = F.translate(F.lower(text), "_|~#", "    ")
    t = F.regexp_replace(t, SPDX_LINE, "|spdx $1|spdx $2|")
    t = F.regexp_replace(t, r"\bv[.]\s+(?=[0-9])", "v ")
    t = F.regexp_replace(t, "([0-9])[.](?=[0-9])", "$1_")
    t = F.translate(F.regexp_replace(t, END, "|"), "\n", "~")
    t = F.concat(F.lit("|"), F.regexp_replace(t, "[^a-z0-9_|~]+", " "), F.lit("|"))
    t = F.regexp_replace(t, "[ ~|]*(?:[|]|~ ?~)[ ~|]*", "|")
    return F.regexp_replace(t, " ?~ ?", "~")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences that each document states.

    A sentence ends at one of ``. ! ? ; :`` before white space (not in ``v. 2.0``) or at an empty line; it may end at
    any other line's end, but a longer known one that goes on over the line's end counts first. Known sentences become
    identifiers with their version; rules are tried in order on the sequence of a document's identifiers (other
    sentences may lie between), and what a rule matches is not there for later ones; a GNU licence without a version
    goes where the document states a version of it. Returns one row per document:
    doc_id, n_sentences (known ones, repeats included), identifiers and licenses (comma-separated; licences in order of
    their rules, with the versions that their sentences state), or null where there are none. Nulls: a null text has
    none. Repeated rows give a row each. Other columns are ignored. An empty table gives no rows. It is one projection:
    no join and no shuffle.
    """
    lookup = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    sentences = F.regexp_extract_all(_marked(text_of()), F.lit(f"(?<=[|~])({_KNOWN})(?=[|~])"), F.lit(1))

    def known(s: Column) -> Column:
        clean = F.regexp_replace(F.translate(s, "~|", "  "), "[0-9]+(_[0-9]+)*", "#")
        for pattern, name in _NAMES:
            clean = F.regexp_replace(clean, pattern, name)
        return F.struct(F.try_element_at(lookup, clean).alias("id"), F.translate(F.regexp_extract(s, "[0-9]+(_[0-9]+)*", 0), "_", ".").alias("version"))

    found = F.filter(F.transform(sentences, known), lambda x: x["id"].isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text_of().rlike(CUE), found).alias("found"))
    rows = rows.withColumn("found", F.when(F.size("found") > 0, F.col("found")))
    # The sequence as text: ",id@version,id@version,"; a rule's first group is its version.
    sequence = F.concat(F.lit(","), F.array_join(F.transform("found", lambda x: F.concat(x["id"], F.lit("@"), x["version"])), ","), F.lit(","))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_pattern(ids, at)).alias("pattern")) for name, ids, at in RULES])
    none = F.array().cast("array<string>")

    def apply(seen: Column, rule: Column) -> Column:
        versions = F.regexp_extract_all(seen["ids"], rule["pattern"], F.lit(1))
        names = F.transform(versions, lambda v: F.replace(rule["name"], F.lit("#"), v))
        return F.struct(F.regexp_replace(seen["ids"], rule["pattern"], F.lit(",-")).alias("ids"), F.concat(seen["out"], names).alias("out"))

    def explained(out: Column) -> Column:
        bare = lambda x: x.isin(*GNU) & F.exists(out, lambda y: y.startswith(F.concat(x, F.lit("-"))))
        return F.filter(out, lambda x: ~bare(x))

    licenses = F.array_distinct(F.aggregate(rules, F.struct(sequence.alias("ids"), none.alias("out")), apply, lambda x: explained(x["out"])))
    rows = rows.withColumn("licenses", F.when(F.col("found").isNotNull(), licenses))
    return rows.select(
        "doc_id",
        F.greatest(F.size("found"), F.lit(0)).cast("int").alias("n_sentences"),
        F.array_join(F.transform("found", lambda x: x["id"]), ",").alias("identifiers"),
        F.when(F.size("licenses") > 0, F.array_join("licenses", ",")).alias("licenses"),
    ).withColumn("n_sentences", F.coalesce("n_sentences", F.lit(0)))


def _pattern(ids: list[str], version: int | None) -> str:
    """A rule's identifiers in a sequence's text."""
    return "".join(f",{x}@" + ("([^,]*)" if i == version else "[^,]*") for i, x in enumerate(ids)) + ("()" if version is None else "") + "(?=,)"


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document states."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Written on the notices as they stand in the documents, with none of the tables and patterns above.
SQL = r"""
with f as (select doc_id, regexp_extract_all(coalesce(text, ''),
  'This work is licensed under the GNU General Public License, version [0-9]+[.]|Licensed under CC BY(-[A-Z]+)* [0-9.]+[0-9][.]|Licensed under the Apache License, Version [0-9.]+[0-9][.]|Released under the MIT License[.]') as m from documents),
k as (select doc_id, m, list_transform(m, lambda x: case when x like '%GNU%' then 'gpl-line' when x like '%Apache%' then 'apache-line' when x like '%MIT%' then 'mit-line'
  else lower(replace(regexp_extract(x, 'CC BY(-[A-Z]+)*'), ' ', '-')) || '-line' end) as ids,
  list_transform(m, lambda x: regexp_extract(x, '[0-9]+([.][0-9]+)*')) as v from f),
l as (select doc_id, m, ids, list_distinct(list_transform(list_zip(ids, v), lambda p: struct_pack(o := case when p[1] = 'apache-line' then '1Apache-' || p[2] when p[1] = 'mit-line' then '2MIT'
  when p[1] = 'gpl-line' then '3GPL-' || p[2] else '4' || upper(left(p[1], length(p[1]) - 5)) || '-' || p[2] end))) as o from k)
select doc_id, len(m)::int as n_sentences, case when len(m) > 0 then array_to_string(ids, ',') end as identifiers,
  case when len(m) > 0 then array_to_string(list_transform(list_sort(o), lambda x: substr(x.o, 2)), ',') end as licenses from l
"""
