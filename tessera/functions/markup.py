"""Labelled figures from web pages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.scalar import clean_number


def _element(tag: str, css_class: str) -> str:
    """Pattern of an opening tag that has the class, in quotes of either kind."""
    name = re.escape(css_class)
    quoted = "|".join(f"{q}(?:[^{q}]*\\s)?{name}(?:\\s[^{q}]*)?{q}" for q in ('"', "'"))
    return rf"<{tag}\b[^>]*\bclass\s*=\s*(?:{quoted})[^>]*>"


# The entities that figures and their labels use.
_ENTITIES = {"&nbsp;": " ", "&#160;": " ", "&#44;": ",", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def plain_text(markup: Column, between: str = " ") -> Column:
    """Text of an element: tags replaced by ``between``, entities decoded, runs of white space made one space."""
    text = F.regexp_replace(markup, "<[^>]*>", between)
    for entity, character in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " "))


def labeled_number(
    html: Column, keyword: str, item: str = "numbers-item", number: str = "numbers-number", label: str = "numbers-description"
) -> Column:
    """First whole number on the page whose label contains ``keyword``; NULL when there is none.

    A figure is a ``div`` of class ``item`` that holds a ``p`` of class ``number`` and one of class
    ``label``, at any depth; it reaches to the next such ``div``. The digits of a number may be spread over
    elements. The whole page is searched.
    """
    blocks = F.split(html, rf"(?i){_element('div', item)}")
    figures = F.transform(
        F.slice(blocks, 2, F.greatest(F.size(blocks), F.lit(1))),
        lambda b: F.struct(
            F.regexp_extract(b, rf"(?is){_element('p', number)}(.*?)</p>", 1).alias("number"),
            F.regexp_extract(b, rf"(?is){_element('p', label)}(.*?)</p>", 1).alias("label"),
        ),
    )
    values = F.transform(
        figures, lambda f: F.when(plain_text(f["label"]).contains(keyword), clean_number(plain_text(f["number"], "")))
    )
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))
