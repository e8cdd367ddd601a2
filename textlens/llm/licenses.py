"""Licences found by their sentences, in DataFrame functions only.

A text is cut into sentences, known sentences become identifiers, and the sequence of identifiers is
reduced by ordered licence rules, each taking the identifiers it explains out of the sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The SQL of the query looks at sentences with any of these words only, before they are normalised.
KEYWORDS = "licen[cs]e|copyright|permission|redistribut|warrant|spdx|public domain|rights reserved|software is provided|endorse or promote"

# (identifier, pattern searched in the normalised sentence). A sentence takes every identifier
# whose pattern it holds, in this order. Fixed wording of public licences.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("spdx-mit", "spdx license identifier mit( |$)"),
    ("spdx-apache-2", "spdx license identifier apache 2.0"),
    ("spdx-gpl-2-plus", "spdx license identifier gpl 2.0 (or later|plus)"),
    ("spdx-gpl-2", "spdx license identifier gpl 2.0( only)?$"),
    ("spdx-gpl-3-plus", "spdx license identifier gpl 3.0 (or later|plus)"),
    ("spdx-gpl-3", "spdx license identifier gpl 3.0( only)?$"),
    ("spdx-bsd-3", "spdx license identifier bsd 3 clause"),
    ("spdx-bsd-2", "spdx license identifier bsd 2 clause"),
    ("spdx-mpl-2", "spdx license identifier mpl 2.0"),
    ("spdx-isc", "spdx license identifier isc( |$)"),
    ("copyright-notice", "copyright (c )?[0-9][0-9][0-9][0-9]"),
    ("all-rights", "all rights reserved"),
    ("apache-ref-2", "licensed under the apache license,? version 2"),
    ("apache-limits", "you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at"),
    ("apache-basis", "software distributed under the license is distributed on an as is basis"),
    ("mit-ref", "(released|licensed|distributed|available) under the (terms of the )?mit license"),
    ("mit-grant", "permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included"),
    ("mit-disclaimer", "the software is provided as is,? without warranty of any kind"),
    ("isc-grant", "permission to use,? copy,? modify,? and(/or)? distribute this software for any purpose"),
    ("isc-disclaimer", "the software is provided as is and the author disclaims all warranties"),
    ("bsd-grant", "redistribution and use in source and binary forms,? with or without modification"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", "may be used to endorse or promote products"),
    ("bsd-disclaimer", "this software is provided by the .* as is and any express or implied warranties"),
    ("bsd-ref", "(released|licensed|distributed|available) under (the |a )?(terms of the )?bsd license"),
    ("gpl-3-plus", "gnu general public license.* version 3.*any later version"),
    ("gpl-3", "gnu general public license,? version 3([^0-9]|$)"),
    ("gpl-2-plus", "gnu general public license.* version 2.*any later version"),
    ("gpl-2", "gnu general public license,? version 2([^0-9]|$)"),
    ("lgpl-ref", "gnu (lesser|library) general public license"),
    ("agpl-ref", "gnu affero general public license"),
    ("gpl-warranty", "without even the implied warranty of merchantability or fitness"),
    ("mpl-ref-2", "mozilla public license,? (version|v) ?2"),
    ("cc-by-nc-sa-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by nc sa 4.0"),
    ("cc-by-nc-nd-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by nc nd 4.0"),
    ("cc-by-nc-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by nc 4.0"),
    ("cc-by-sa-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by sa 4.0"),
    ("cc-by-nd-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by nd 4.0"),
    ("cc-by-4", "(licensed|released|available) under (a |the )?(cc|creative commons) by 4.0"),
    ("public-domain", "(released|dedicated|placed) (in|in to|into|to) the public domain"),
)

# (licence, pattern over the sequence of <identifier>). Applied in this order, everywhere in the sequence.
RULES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "<apache-ref-2>(<apache-limits>)?(<apache-copy>)?(<apache-basis>)?"),
    ("MIT", "<mit-grant><mit-notice><mit-disclaimer>"),
    ("ISC", "<isc-grant>(<isc-disclaimer>)?"),
    ("BSD-3-Clause", "<bsd-grant>(<bsd-source>)?(<bsd-binary>)?<bsd-endorse>(<bsd-disclaimer>)?"),
    ("BSD-2-Clause", "<bsd-grant><bsd-source><bsd-binary>(<bsd-disclaimer>)?"),
    ("GPL-3.0-or-later", "<gpl-3-plus>(<gpl-3>)?(<gpl-warranty>)?"),
    ("GPL-2.0-or-later", "<gpl-2-plus>(<gpl-2>)?(<gpl-warranty>)?"),
    ("GPL-3.0-only", "<gpl-3>(<gpl-warranty>)?"),
    ("GPL-2.0-only", "<gpl-2>(<gpl-warranty>)?"),
    ("LGPL", "<lgpl-ref>(<gpl-warranty>)?"),
    ("AGPL", "<agpl-ref>(<gpl-warranty>)?"),
    ("MPL-2.0", "<mpl-ref-2>"),
    ("CC-BY-NC-SA-4.0", "<cc-by-nc-sa-4>"),
    ("CC-BY-NC-ND-4.0", "<cc-by-nc-nd-4>"),
    ("CC-BY-NC-4.0", "<cc-by-nc-4>"),
    ("CC-BY-SA-4.0", "<cc-by-sa-4>"),
    ("CC-BY-ND-4.0", "<cc-by-nd-4>"),
    ("CC-BY-4.0", "<cc-by-4>"),
    ("MIT", "<spdx-mit>|<mit-ref>|<mit-grant>"),
    ("Apache-2.0", "<spdx-apache-2>"),
    ("GPL-2.0-or-later", "<spdx-gpl-2-plus>"),
    ("GPL-2.0-only", "<spdx-gpl-2>"),
    ("GPL-3.0-or-later", "<spdx-gpl-3-plus>"),
    ("GPL-3.0-only", "<spdx-gpl-3>"),
    ("BSD-3-Clause", "<spdx-bsd-3>"),
    ("BSD-2-Clause", "<spdx-bsd-2>"),
    ("BSD", "<bsd-ref>|<bsd-grant>"),
    ("MPL-2.0", "<spdx-mpl-2>"),
    ("ISC", "<spdx-isc>"),
    ("Public-Domain", "<public-domain>"),
)

# Creative Commons licences by their full names; these and their rules follow the ones above.
NAMES: tuple[tuple[str, str], ...] = (
    ("cc-by-nc-sa-4-name", "creative commons attribution non ?commercial share ?alike 4.0"),
    ("cc-by-nc-nd-4-name", "creative commons attribution non ?commercial no ?deriv(ative)?s 4.0"),
    ("cc-by-nc-4-name", "creative commons attribution non ?commercial 4.0"),
    ("cc-by-sa-4-name", "creative commons attribution share ?alike 4.0"),
    ("cc-by-nd-4-name", "creative commons attribution no ?deriv(ative)?s 4.0"),
    ("cc-by-4-name", "creative commons attribution 4.0"),
)

# The short form just before is the same grant.
NAME_RULES: tuple[tuple[str, str], ...] = (
    ("CC-BY-NC-SA-4.0", r"(\[CC-BY-NC-SA-4\.0\])?<cc-by-nc-sa-4-name>"),
    ("CC-BY-NC-ND-4.0", r"(\[CC-BY-NC-ND-4\.0\])?<cc-by-nc-nd-4-name>"),
    ("CC-BY-NC-4.0", r"(\[CC-BY-NC-4\.0\])?<cc-by-nc-4-name>"),
    ("CC-BY-SA-4.0", r"(\[CC-BY-SA-4\.0\])?<cc-by-sa-4-name>"),
    ("CC-BY-ND-4.0", r"(\[CC-BY-ND-4\.0\])?<cc-by-nd-4-name>"),
    ("CC-BY-4.0", r"(\[CC-BY-4\.0\])?<cc-by-4-name>"),
)

# Every pattern of SENTENCES and NAMES implies one of these in the normalised sentence (tested one by one).
TELLING = "licen[cs]e|copyright|permission|redistribut|warrant|public domain|rights reserved|software is provided|endorse or promote|(cc|commons) by|commons attribution"

# Identifiers that name no licence by themselves.
NEUTRAL = "<copyright-notice>|<all-rights>"


def sentences(text: Column) -> Column:
    """Sentences: cut after ``.``, ``!``, ``?`` before white space, and at empty lines; other line ends are spaces."""
    parted = F.regexp_replace(text, r"\r?\n[ \t\r]*\n", "\u0001")
    parted = F.regexp_replace(parted, r"([.!?])[ \t\r\n]+", "$1\u0001")
    return F.split(parted, "\u0001")


def normal_sentence(sentence: Column) -> Column:
    """Lower case without quotes and comment marks, ``-`` and ``:`` as spaces, final stops removed, spaces single."""
    plain = F.regexp_replace(F.lower(sentence), r"[\"'`()*#;]", "")
    spaced = F.trim(F.regexp_replace(plain, r"[\s:-]+", " "))
    return F.regexp_replace(spaced, r"[.!? ]+$", "")


def license_scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    known: Sequence[tuple[str, str]] = SENTENCES + NAMES,
    rules: Sequence[tuple[str, str]] = RULES + NAME_RULES,
) -> DataFrame:
    """``(key, n_sentences, sentence_ids, licenses, left_over, verdict)``, one row per row of ``docs``.

    ``sentence_ids`` is the sequence of known sentences as ``<id><id>``, ``licenses`` the licences
    in the order of the text, joined by commas, each as often as its rule matched, ``left_over`` the
    identifiers that no rule explains. ``verdict`` is ``none`` (no known sentence), ``known`` (every
    telling identifier explained), ``partly`` or ``unknown`` (no licence, but telling identifiers).
    Null and empty texts have no sentence and the verdict ``none``. Rows are looked at one by one: there is no
    shuffle, so repeated rows, ties and hot keys need no care, and other columns are not read.
    """
    cut_up = F.filter(sentences(F.col(text)), lambda s: F.trim(s) != "")
    normal = F.transform(cut_up, normal_sentence)
    if set(known) <= {*SENTENCES, *NAMES}:  # other sentences may hold none of these words
        normal = F.filter(normal, lambda s: s.rlike(TELLING))

    def found(sentence: Column) -> Column:
        return F.array_join(F.array(*[F.when(sentence.rlike(p), F.lit(f"<{i}>")) for i, p in known]), "")

    listed = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.size(F.when(F.col(text).isNotNull(), cut_up)), F.lit(0)).alias("n_sentences"),
        F.coalesce(F.array_join(F.transform(normal, found), ""), F.lit("")).alias("sentence_ids"),
    )
    reduced = F.col("sentence_ids")
    for name, pattern in rules:
        reduced = F.regexp_replace(reduced, pattern, f"[{name}]")
    seen = listed.withColumn("_reduced", F.when(F.col("sentence_ids") == "", F.lit("")).otherwise(reduced))
    names = F.regexp_extract_all("_reduced", F.lit(r"\[([^\]]*)\]"), F.lit(1))
    left = F.regexp_replace("_reduced", r"\[[^\]]*\]", "")
    named = seen.select(
        F.col("key").alias(key), "n_sentences", "sentence_ids", F.array_join(names, ",").alias("licenses"), left.alias("left_over")
    )
    open_ids = F.regexp_replace("left_over", NEUTRAL, "") != ""
    verdict = (
        F.when(F.col("sentence_ids") == "", "none")
        .when(F.col("licenses") == "", F.when(open_ids, "unknown").otherwise("none"))
        .when(open_ids, "partly")
        .otherwise("known")
    )
    return named.withColumn("verdict", verdict)
