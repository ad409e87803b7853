"""The two rule sets that chunking runs under."""

from __future__ import annotations

from dataclasses import dataclass

# Misread strings and what replaces them, applied in this order.
CORRECTIONS = (
    ("intllience", "intelligence"),
    ("artifical", "artificial"),
    ("wasestimated", "was estimated"),
    ("projectedto", "projected to"),
    ("heldin2023", "held in 2023"),
    ("byit.ChatGPT", "by it. ChatGPT"),
    ("andthe", "and the"),
    ("Nowimagine", "Now imagine"),
    ("theend", "the end"),
    ("thischapter", "this chapter"),
    ("fieldofartificial", "field of artificial"),
)
SHORT_CORRECTIONS = (
    ("intllience", "intelligence"),
    ("artifical", "artificial"),
    ("wasestimated", "was estimated"),
    ("projectedto", "projected to"),
    ("andthe", "and the"),
    ("theend", "the end"),
)
# Levels of block types; every other type has DEEPEST.
LEVELS = {"doc_title": 1, "title": 2, "header": 3, "paragraph_title": 4}
DEEPEST = 5
HEADINGS = ("doc_title", "title", "header", "paragraph_title")
BREAKS = ("doc_title", "title")
MIN_TOKENS, MAX_TOKENS = 150, 400
OVERLAP = 0.5
MIN_CONFIDENCE, MIN_LETTERS, MAX_SPECIAL, MIN_LENGTH = 0.85, 0.5, 0.5, 2


@dataclass(frozen=True)
class Mode:
    """grid: match by grid cells instead of the whole page. page_parent: level-2 elements without a level-1 one go under the page's first title. item_ids: ids and metadata carry the item."""

    corrections: tuple[tuple[str, str], ...] = CORRECTIONS
    grid: bool = False
    page_parent: bool = True
    quality: bool = False
    item_ids: bool = False


ENHANCED = Mode()
LAMBDA = Mode(SHORT_CORRECTIONS, page_parent=False, quality=True, item_ids=True)
