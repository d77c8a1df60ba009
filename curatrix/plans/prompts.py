"""Instructions that go with requests, for corpora that bring none of their own.

They are short on purpose: the tools' schemas name the fields and their values.
"""

from __future__ import annotations

SCOPE = """You sort documents for a survey of foods made without conventional animal farming.
A document is in scope if its main subject is such a food, an ingredient of one, or a process or tool for making them; it is out of scope if these are only mentioned.
Set plant_based for products from plants, fungi or algae as they are grown, fermentation for products made by cultures of micro-organisms, cultivated for animal cells grown outside an animal, and cross_cutting for work that serves several of these.
Give your confidence from 1 (a guess) to 7 (certain). Judge by the title and the abstract alone."""

LABEL = """You label documents on {subject}.
Choose the value of each field that fits the document's main contribution best, from the values that the tool allows, and only from those. Judge by the title and the abstract alone."""

SUBJECTS = {
    "category": "new ways of making food, by the step of development that they are about",
    "endproduct": "new ways of making food, by the product that they lead to",
    "ingredient": "new ways of making food, by the ingredient that they are about",
    "subpillar": "fermentation for food, by whether the culture itself or a substance that it makes is the product",
}


def default(name: str) -> str | None:
    """The instruction for a request type (``scope``, a label type, or ``type.pillar``)."""
    if name == "scope":
        return SCOPE
    subject = SUBJECTS.get(name.split(".")[0])
    return LABEL.format(subject=subject) if subject else None
