"""Licence scans by sentence rules, in column expressions only.

A text is cut into sentences, those that name anything legal are normalised and mapped to identifiers of known licence
sentences, and the sequence of identifiers is matched against ordered rules. A rule takes the identifiers it matches out
of the sequence, so a longer text wins over a short notice that it contains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licence texts and notices, as patterns over normalised sentences.
SENTENCES: list[tuple[str, str]] = [
    ("spdx_mit", r"spdx-license-identifier mit"),
    ("spdx_apache2", r"spdx-license-identifier apache-2\.0"),
    ("spdx_bsd2", r"spdx-license-identifier bsd-2-clause"),
    ("spdx_bsd3", r"spdx-license-identifier bsd-3-clause"),
    ("spdx_gpl2", r"spdx-license-identifier gpl-2\.0"),
    ("spdx_gpl3", r"spdx-license-identifier gpl-3\.0"),
    ("spdx_tag", r"spdx-license-identifier"),
    ("apache2_notice", r"licensed under the apache license,? version 2\.0"),
    ("apache2_file", r"you may not use this file except in compliance with the license"),
    ("apache2_copy", r"you may obtain a copy of the license at"),
    ("apache2_asis", r"unless required by applicable law or agreed to in writing"),
    ("apache2_see", r"see the license for the specific language governing permissions"),
    ("mit_grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included"),
    ("asis_software", r"the software is provided as is, without warranty of any kind"),
    ("mit_liability", r"in no event shall the authors or copyright holders be liable"),
    ("mit_name", r"under the mit license"),
    ("isc_grant", r"permission to use, copy, modify, and or distribute this software for any purpose"),
    ("bsd_grant", r"redistribution and use in source and binary forms, with or without modification"),
    ("bsd_source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_endorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsd_advert", r"all advertising materials mentioning features or use of this software"),
    ("bsd_asis", r"this software is provided by .* as is and any express or implied warranties"),
    ("bsd_name", r"under the (2-clause |3-clause |new |modified )?bsd license"),
    ("lgpl_notice", r"under the terms of the gnu (lesser|library) general public license"),
    ("agpl_notice", r"under the terms of the gnu affero general public license"),
    ("gpl_notice", r"under the terms of the gnu general public license"),
    ("lgpl3_name", r"under the gnu lesser general public license,? version 3"),
    ("agpl3_name", r"under the gnu affero general public license,? version 3"),
    ("gpl2_name", r"under the gnu general public license,? version 2"),
    ("gpl3_name", r"under the gnu general public license,? version 3"),
    ("gpl_later", r"either version (2|3|2\.1)( of the license)?,? or (\(? ?at your option\)? ?)?any later version"),
    ("gpl_warranty", r"without even the implied warranty of merchantability or fitness"),
    ("gpl_received", r"you should have received a copy of the gnu"),
    ("mpl2_notice", r"subject to the terms of the mozilla public license,? v\. ?2\.0"),
    ("epl_notice", r"under the terms of the eclipse public license"),
    ("cc0_notice", r"(cc0|waived all copyright|creative commons zero)"),
    ("ccbyncsa_name", r"under (a )?(cc|creative commons) (by-nc-sa|attribution-noncommercial-sharealike)"),
    ("ccbyncnd_name", r"under (a )?(cc|creative commons) (by-nc-nd|attribution-noncommercial-noderivatives)"),
    ("ccbync_name", r"under (a )?(cc|creative commons) (by-nc|attribution-noncommercial)"),
    ("ccbysa_name", r"under (a )?(cc|creative commons) (by-sa|attribution-sharealike)"),
    ("ccbynd_name", r"under (a )?(cc|creative commons) (by-nd|attribution-noderivatives)"),
    ("ccby_name", r"under (a )?(cc|creative commons) (by|attribution)"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public_domain", r"(placed|released|is) in(to)? the public domain"),
    ("all_rights", r"all rights reserved"),
    ("copyright", r"copyright (\(c\) |c )?[0-9]{4}"),
    ("other_license", r"licen[sc]ed? under"),
]

# Rules over the sequence "|id|id|…|", tried in this order.
RULES: list[tuple[str, str]] = [
    ("MIT", r"\|spdx_mit\|"),
    ("Apache-2.0", r"\|spdx_apache2\|"),
    ("BSD-2-Clause", r"\|spdx_bsd2\|"),
    ("BSD-3-Clause", r"\|spdx_bsd3\|"),
    ("GPL-2.0", r"\|spdx_gpl2\|"),
    ("GPL-3.0", r"\|spdx_gpl3\|"),
    ("MIT", r"\|mit_grant\|(mit_notice\|)?(asis_software\|)?(mit_liability\|)?"),
    ("ISC", r"\|isc_grant\|(asis_software\|)?"),
    ("BSD-4-Clause", r"\|bsd_grant\|bsd_source\|bsd_binary\|bsd_advert\|(bsd_endorse\|)?(bsd_asis\|)?"),
    ("BSD-3-Clause", r"\|bsd_grant\|bsd_source\|bsd_binary\|bsd_endorse\|(bsd_asis\|)?"),
    ("BSD-2-Clause", r"\|bsd_grant\|bsd_source\|bsd_binary\|(bsd_asis\|)?"),
    ("Apache-2.0", r"\|apache2_notice\|(apache2_file\|)?(apache2_copy\|)?(apache2_asis\|)?(apache2_see\|)?"),
    ("LGPL-or-later", r"\|lgpl_notice\|gpl_later\|(gpl_warranty\|)?(gpl_received\|)?"),
    ("LGPL", r"\|(lgpl_notice|lgpl3_name)\|(gpl_warranty\|)?(gpl_received\|)?"),
    ("AGPL", r"\|(agpl_notice|agpl3_name)\|(gpl_later\|)?(gpl_warranty\|)?(gpl_received\|)?"),
    ("GPL-or-later", r"\|gpl_notice\|gpl_later\|(gpl_warranty\|)?(gpl_received\|)?"),
    ("GPL-2.0", r"\|gpl2_name\|"),
    ("GPL-3.0", r"\|gpl3_name\|"),
    ("GPL", r"\|gpl_notice\|(gpl_warranty\|)?(gpl_received\|)?"),
    ("MPL-2.0", r"\|mpl2_notice\|"),
    ("EPL", r"\|epl_notice\|"),
    ("MIT", r"\|mit_name\|"),
    ("BSD", r"\|bsd_name\|"),
    ("CC0-1.0", r"\|cc0_notice\|"),
    ("CC-BY-NC-SA", r"\|ccbyncsa_name\|"),
    ("CC-BY-NC-ND", r"\|ccbyncnd_name\|"),
    ("CC-BY-NC", r"\|ccbync_name\|"),
    ("CC-BY-SA", r"\|ccbysa_name\|"),
    ("CC-BY-ND", r"\|ccbynd_name\|"),
    ("CC-BY", r"\|ccby_name\|"),
    ("Unlicense", r"\|unlicense\|"),
    ("public-domain", r"\|public_domain\|"),
    ("proprietary", r"\|(copyright\|)?all_rights\|"),
]

#: A sentence ends at a mark before white space. White space is spelled out, as engines differ in theirs.
SENTENCE_END = r"[.!?;][ \t\n\r\f]+"
#: Every sentence above holds one of these.
LEGAL = (
    r"licen[sc]e|permission|copyright|redistribution|warrant|liable|endorse|advertising|required by applicable|"
    r"software is provided|later version|received a copy|public domain|all rights|cc0|creative commons|cc by"
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DROPPED = r"[^a-z0-9.,()-]+"


def _normalised(sentence: Column) -> Column:
    """Lower-case, with quotes, comment marks, white space and all else beyond ASCII words as single blanks."""
    return F.trim(F.regexp_replace(sentence, _DROPPED, " "))


def _identifier(sentence: Column) -> Column:
    known = F.when(F.lit(False), "")
    for name, pattern in SENTENCES:
        known = known.when(sentence.rlike(pattern), name)
    return known


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known licence sentences of a text, in order."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    sentences = F.filter(F.split(lowered, SENTENCE_END, -1), lambda s: s.rlike(_loose(LEGAL)))
    ids = F.filter(F.transform(sentences, lambda s: _identifier(_normalised(s))), lambda x: x.isNotNull())
    return F.when(lowered.rlike(_loose(LEGAL)), ids).otherwise(F.array().cast("array<string>"))


def _loose(pattern: str) -> str:
    """Blanks of a pattern match whatever normalisation turns into a blank."""
    return pattern.replace(" ", _DROPPED)


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, licenses, sentence_ids, n_sentences)`` of every row.

    ``licenses`` are the rules that matched, in the order of the rules, each once, comma-joined; "unknown" if only
    licence sentences were left that no rule takes; "none" without any, as for null and empty texts. Repeated rows are
    scanned each for itself, ids may be null, an empty table gives an empty one.
    """
    found = docs.select("doc_id", sentence_ids(F.col("text")).alias("ids"))
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in RULES])
    start = F.struct(
        F.concat(F.lit("|"), F.array_join("ids", "|"), F.lit("|")).alias("rest"),
        F.array().cast("array<string>").alias("names"),
    )

    def apply(state: Column, rule: Column) -> Column:
        matches = F.regexp_like(state["rest"], rule["pattern"])
        names = F.when(matches, F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"])
        return F.struct(F.regexp_replace(state["rest"], rule["pattern"], F.lit("|")).alias("rest"), names.alias("names"))

    names = F.when(F.size("ids") > 0, F.aggregate(rules, start, apply, lambda s: s["names"]))
    licenses = F.when(F.size("ids") == 0, "none").when(F.size(names) == 0, "unknown").otherwise(F.array_join(names, ","))
    return found.select(
        "doc_id",
        licenses.alias("licenses"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.size("ids").cast("long").alias("n_sentences"),
    )


def sql() -> str:
    """The same as one statement for a column store: rules become a chain of columns."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    cases = " ".join(f"WHEN regexp_matches(s, {quoted(p)}) THEN {quoted(n)}" for n, p in SENTENCES)
    steps, last = [], "ids"
    for i, (name, pattern) in enumerate(RULES):
        names = f"CASE WHEN regexp_matches(rest, {quoted(pattern)}) AND NOT list_contains(names, {quoted(name)}) "
        names += f"THEN list_append(names, {quoted(name)}) ELSE names END"
        rest = f"regexp_replace(rest, {quoted(pattern)}, '|', 'g')"
        steps.append(f"r{i} AS (SELECT doc_id, ids, {rest} AS rest, {names} AS names FROM {last})")
        last = f"r{i}"
    legal = quoted(_loose(LEGAL))
    split = f"string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {quoted(SENTENCE_END)})"
    normal = f"trim(regexp_replace(x, {quoted(_DROPPED)}, ' ', 'g'))"
    return f"""
WITH cut AS (SELECT doc_id, list_filter({split}, lambda x: regexp_matches(x, {legal})) AS parts FROM documents),
normal AS (SELECT doc_id, list_transform(parts, lambda x: {normal}) AS parts FROM cut),
named AS (
  SELECT doc_id, list_filter(list_transform(parts, lambda s: CASE {cases} END), lambda s: s IS NOT NULL) AS ids FROM normal),
ids AS (SELECT doc_id, ids, '|' || array_to_string(ids, '|') || '|' AS rest, []::VARCHAR[] AS names FROM named),
{", ".join(steps)}
SELECT doc_id,
  CASE WHEN len(ids) = 0 THEN 'none' WHEN len(names) = 0 THEN 'unknown' ELSE array_to_string(names, ',') END AS licenses,
  array_to_string(ids, ',') AS sentence_ids, len(ids)::BIGINT AS n_sentences
FROM {last}"""
