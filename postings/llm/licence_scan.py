"""Licence scan by sentence rules.

A text is cut into sentences, each normalised to lower-case letters, digits and
single spaces. Known licence sentences become identifiers; what a text says about
its licence is then the sequence of its identifiers, and a rule is a sequence
that must occur in it without a gap. Only texts and sentences that hold a key word
are normalised. All of it is SQL functions within the row, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as published, normalised, under identifiers of our own.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-the": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-short": "licensed under the bsd license",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-later-2": "either version 2 of the license or at your option any later version",
    "gpl-later-3": "either version 3 of the license or at your option any later version",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccby4": "licensed under cc by 4 0",
    "ccbysa4": "licensed under cc by sa 4 0",
    "ccbync4": "licensed under cc by nc 4 0",
    "cc-work-by4": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-short": "this work is dedicated to the public domain under cc0 1 0",
    "reserved": "all rights reserved",
}

#: Sentences as notices in use have them besides; the SQL twin has only those above.
PUBLISHED = {
    "gpl-terms-3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-terms-2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
}

# In order; a licence is named by its public short identifier.
RULES = (
    ("Apache-2.0", ("apache-the", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-asis", "apache-see")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("BSD", ("bsd-grant",)),
    ("BSD", ("bsd-short",)),
    ("ISC", ("isc-grant",)),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl-later-2")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl-later-3")),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("MPL-2.0", ("mpl2-form",)),
    ("CC-BY-4.0", ("ccby4",)),
    ("CC-BY-4.0", ("cc-work-by4",)),
    ("CC-BY-SA-4.0", ("ccbysa4",)),
    ("CC-BY-NC-4.0", ("ccbync4",)),
    ("CC0-1.0", ("cc0-short",)),
    ("proprietary", ("reserved",)),
)

PUBLISHED["apache-copy-url"] = SENTENCES["apache-copy"] + " http www apache org licenses license 2 0"
PUBLISHED["apache-copy-asis"] = PUBLISHED["apache-copy-url"] + " " + SENTENCES["apache-asis"]
PUBLISHED_RULES = (
    ("Apache-2.0", ("apache-the", "apache-comply", "apache-copy-url")),
    ("Apache-2.0", ("apache-the", "apache-comply", "apache-copy-asis")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms-2")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms-3")),
)

#: Every known sentence holds one of these.
KEYS = ("licens", "licenc", "copyright", "warrant", "permission", "redistribut", "free software", "rights reserved", "either version", "public domain")
KEY = "(?i)" + "|".join(k.replace(" ", r"[^a-z0-9]+") for k in KEYS)
_END = r"[.!?;:][\x20\x09-\x0D]+"
#: May stand before and after a sentence of these beginnings.
_SHORT = ("licensed under ", "released under ")
_LEAD = r"(?:(?:this|the|all)[ \n](?:[a-z0-9]+[ \n]){0,4}?(?:is|are)[ \n])?"
#: May stand before a notice that a heading is run together with.
_HEAD = r"(?:(?:[a-z0-9]+[ \n]){0,4}copyright[ \n](?:[a-z0-9]+[ \n]){1,12}?)?"
_NOTICE = ("permission ", "redistribution ", "licensed under the apache license ")
_TAIL = r"(?:[ \n](?:see|read)[ \n](?:the[ \n])?(?:[a-z0-9]+[ \n])?licen[sc]e(?:[ \n](?:md|txt|file))*(?:[ \n]for[ \n](?:more[ \n])?(?:details|information))?)?"


def normalised(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def _pattern(sentence: str) -> str:
    """A sentence from one sentence or line end to another; line ends may stand in it, and after "v." goes a number."""
    words = sentence.replace(" v ", " v\x01").replace(" ", "[ \n]").replace("\x01", "[ \n\x01]")
    return (_HEAD if sentence.startswith(_NOTICE) else "") + (_LEAD + words + _TAIL if sentence.startswith(_SHORT) else words)


def identifiers(text: Column, sentences: Mapping[str, str]) -> Column:
    """The known sentences of a text in order. A line end may close a sentence or stand in it, at each line anew."""
    t = F.translate(F.lower(text), "\x01", " ")
    for old, new in ((_END, "\x01"), ("[^a-z0-9\x01\n]+", " "), ("[ \n]*\x01[ \n\x01]*", "\x01"), (" ?\n[ \n]*", "\n")):
        t = F.regexp_replace(t, old, new)
    # Longer sentences are tried first, so none is taken for its own beginning.
    either = "|".join(_pattern(x) for x in sorted(sentences.values(), key=len, reverse=True))
    found = F.regexp_extract_all(F.trim(t), F.lit(f"(?<![^\x01\n])(?:{either})(?![^\x01\n])"), F.lit(0))
    known = F.map_from_arrays(F.array(*map(F.lit, sentences.values())), F.array(*map(F.lit, sentences)))

    def identifier(match: Column) -> Column:
        whole = F.translate(match, "\n\x01", "  ")
        short = F.regexp_replace(F.regexp_replace(whole, f"^{_HEAD}(?={'|'.join(_NOTICE)})|^{_LEAD}(?={'|'.join(_SHORT)})", ""), f"{_TAIL}$", "")
        return F.coalesce(F.try_element_at(known, whole), F.try_element_at(known, short))

    return F.filter(F.transform(found, identifier), lambda i: i.isNotNull())


def _holds(sequence: Column, rule: Sequence[str]) -> Column:
    """Whether the sequence has the rule's identifiers one after another."""
    wanted = F.array(*map(F.lit, rule))
    if len(rule) == 1:
        return F.array_contains(sequence, rule[0])
    starts = F.sequence(F.lit(1), F.greatest(F.size(sequence) - len(rule) + 1, F.lit(1)))
    return F.exists(starts, lambda i: F.slice(sequence, i, len(rule)) == wanted)


def scan(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES | PUBLISHED, rules: Sequence[tuple[str, Sequence[str]]] = RULES + PUBLISHED_RULES) -> DataFrame:
    """(doc_id, sentence_ids, licences) of every row: identifiers in text order, licences distinct in rule order.

    NULL, empty and licence-free texts have empty arrays; a sentence that repeats is in the sequence each time; repeated
    rows get equal results. Other columns are ignored.
    """
    for name, sentence in sentences.items():
        if not re.search(KEY, sentence) or normalised(sentence) != sentence:
            raise ValueError(f"sentence {name} is not normalised or holds no key word")
    none = F.array().cast("array<string>")
    d = docs.select("doc_id", "text").withColumn("holds", F.coalesce(F.col("text").rlike(KEY), F.lit(False)))
    d = d.select("doc_id", F.when(F.col("holds"), identifiers(F.col("text"), sentences)).otherwise(none).alias("sentence_ids"))
    found = F.array_compact(F.array(*[F.when(_holds(F.col("sentence_ids"), ids), F.lit(name)) for name, ids in rules]))
    return d.withColumn("licences", F.when(F.size("sentence_ids") > 0, F.array_distinct(found)).otherwise(none))


def oracle(sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> str:
    """The same scan in DuckDB's SQL, with joins on exploded sentences and on stretches of identifiers."""
    known = ", ".join(f"('{i}', '{s}')" for i, s in sentences.items())
    wanted = ", ".join(f"({k}, '{name}', [{', '.join(repr(i) for i in ids)}])" for k, (name, ids) in enumerate(rules))
    return rf"""
WITH known(id, sentence) AS (VALUES {known}),
rule(n, licence, ids) AS (VALUES {wanted}),
readings AS (
  SELECT doc_id, 0 AS folded, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT doc_id, 1, translate(coalesce(text, ''), chr(10), ' ') FROM documents
), pieces AS (
  SELECT doc_id, folded, string_split(regexp_replace(t, '([.!?;:])[\x20\x09\x0B-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS p FROM readings
), each AS (
  SELECT doc_id, folded, unnest(p) AS s, generate_subscripts(p, 1) AS place FROM pieces
), ids AS (
  SELECT doc_id, folded, list(id ORDER BY place) AS ids
  FROM each JOIN known ON trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) = sentence GROUP BY ALL
), best AS (
  SELECT doc_id, ids FROM ids QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len(ids) DESC, folded) = 1
), hits AS (
  SELECT DISTINCT b.doc_id, r.n, r.licence FROM best b, rule r
  WHERE len(list_filter(range(1, len(b.ids) + 1), lambda i: b.ids[i:i + len(r.ids) - 1] = r.ids)) > 0
), named AS (
  SELECT doc_id, list(licence ORDER BY n) AS l FROM (SELECT doc_id, licence, min(n) AS n FROM hits GROUP BY ALL) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(b.ids), 0)::BIGINT AS n_sentences, coalesce(array_to_string(b.ids, ' '), '') AS sentence_ids,
       coalesce(array_to_string(n.l, ' '), '') AS licences
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
