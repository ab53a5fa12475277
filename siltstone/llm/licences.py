"""Licence scan: Dice coefficient over word bigrams against licence templates (DataFrame functions only).

A text's segments are its lines, its paragraphs (between blank lines) and itself as a whole. A segment is normalised
(lower case; every run of other characters than letters and digits separates words) and compared to the
templates: Dice = 2 |A ∩ B| / (|A| + |B|) over the sets of word bigrams. Dice >= t is possible only if
|A| lies between |B| t / (2 - t) and |B| (2 - t) / t, so templates out of that range are pruned
before any intersection. A match shares at least |B| t / (2 - t) bigrams with its template, so a few of the template's words,
chosen to touch all but fewer of its bigrams, cannot all be missing: texts and segments without any of these
words are passed over by plain substring search. Everything is row-local: no shuffle, and the templates are constants of the plan.

Null and empty texts match nothing. Repeated segments count once. Ties between templates are all reported. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Short statements, standard notices and short full texts of public licences. Longer licences are known by their notices.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.',
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
        'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.',
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'The software is provided "as is" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.',
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def flat_templates(templates: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    return [(name, grams) for name, texts in templates.items() for t in texts if (grams := template_bigrams(t))]


def bounds(n: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams that can reach the threshold with a template of n."""
    least, most = n * threshold / (2 - threshold), n * (2 - threshold) / threshold
    return int(least) + (least > int(least) + 1e-9), int(most + 1e-9)


def anchor_words(flat: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Words of which every text that matches any template holds at least one (as a substring)."""
    anchors: list[str] = []
    for _, grams in flat:
        left = [g.split(" ") for g in grams]
        spare = bounds(len(grams), threshold)[0] - 1  # so many bigrams may stay untouched
        touched = lambda w: sum(w in g for g in left)
        left = [g for g in left if not any(a in w for a in anchors for w in g)]
        while len(left) > spare:
            best = max(sorted({w for g in left for w in g}), key=lambda w: (len(w) > 4 or w.isdigit(), touched(w), len(w)))
            anchors.append(best)
            left = [g for g in left if best not in g]
    return [a for a in anchors if not any(b in a and b != a for b in anchors)]


def _segments(text: Column) -> Column:
    lines = F.split(text, r"\n")
    paragraphs = F.transform(F.split(text, r"\n[\x20\x09\x0D]*\n"), lambda p: p)
    return F.array_distinct(F.concat(lines, paragraphs, F.array(text)))


def scan_licences(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """doc_id, licences (sorted, comma-joined; null if none), best_dice, n_matches (segment, template pairs): a row
    for each row of docs."""
    flat = flat_templates(templates)
    ranges = [bounds(len(g), threshold) for _, g in flat]
    least, most = min(r[0] for r in ranges), max(r[1] for r in ranges)
    # words of a segment; bigrams as a set, and only for segments whose number of words any template could match
    anchors = anchor_words(flat, threshold)
    holds = lambda c: functools.reduce(operator.or_, [F.contains(c, F.lit(a)) for a in anchors])
    # lower-cased once, in a projection of its own; segments that differ in case only have the same bigrams
    lowered = docs.select("doc_id", F.lower(text_or_empty()).alias("low"))
    low = F.col("low")
    held = F.when(holds(low), F.filter(_segments(low), holds)).otherwise(F.array().cast("array<string>"))
    words = F.transform(held, lambda s: F.filter(F.split(s, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    short = F.filter(words, lambda w: (F.size(w) > least))
    grams = F.transform(
        short,
        lambda w: F.array_distinct(F.transform(F.slice(w, 2, F.size(w)), lambda b, i: F.concat(F.element_at(w, i + 1), F.lit(" "), b))),
    )
    fitting = F.filter(F.array_distinct(grams), lambda g: (F.size(g) >= least) & (F.size(g) <= most))

    def scores(g: Column) -> Column:
        each = []
        for (name, t), (low, high) in zip(flat, ranges, strict=True):
            dice = 2.0 * F.size(F.array_intersect(g, F.array(*map(F.lit, t)))) / (F.size(g) + len(t))
            each.append(F.when((F.size(g) >= low) & (F.size(g) <= high), F.struct(dice.alias("dice"), F.lit(name).alias("name"))))
        return F.filter(F.array(*each), lambda x: x.isNotNull() & (x["dice"] >= threshold))

    found = lowered.select(F.col("doc_id"), F.flatten(F.transform(fitting, scores)).alias("found"))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["name"])))
    return found.select(
        "doc_id",
        F.when(F.size("found") > 0, F.concat_ws(",", names)).alias("licences"),
        F.array_max(F.transform("found", lambda x: x["dice"])).alias("best_dice"),
        F.size("found").cast("long").alias("n_matches"),
    )
