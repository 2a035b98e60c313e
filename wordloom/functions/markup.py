"""Tags that change the context of the words after them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.text import TAG_PART

# Context letter and the tag names that switch it. S marks script, whose words are dropped.
TAG_NAMES = {
    "B": "b|strong",
    "H": "h[1-6]",
    "I": "i|em",
    "T": "title",
    "S": "script",
}
CONTEXTS = ("B", "H", "I", "T")
PLAIN, IN_URL = "P", "U"


_ALL_NAMES = "|".join(TAG_NAMES.values())

# One pass over the page: the group holds words and the tags that switch a context, not the other tags.
# A tag's name ends in white space or the tag's end, and only the last '<' before a '>' starts a tag.
_WORD_OR_SWITCH = rf"(?is)(</?(?:{_ALL_NAMES})(?:\s[^<>]*)?>|[a-z0-9]+)|{TAG_PART}"


def pieces(html: Column) -> Column:
    """The page cut before each switching tag: 'words', 'b> words', '/b> words', …; all else is dropped."""
    kept = F.array_join(F.regexp_extract_all(html, F.lit(_WORD_OR_SWITCH), F.lit(1)), " ")
    return F.split(F.lower(kept), "<")


def piece_words(piece: Column) -> Column:
    return F.array_remove(F.split(F.substring_index(piece, ">", -1), " "), "")


def piece_tag(piece: Column) -> Column:
    """Name of the tag that starts a piece, with the slash of a closing one; '' for the first piece."""
    return F.regexp_extract(piece, r"^(/?\w+)[\s>]", 1)


def tag_kind(tag: Column) -> Column:
    """Context letter a tag switches."""
    name = F.ltrim(tag, F.lit("/"))
    kind = F.lit(None).cast("string")
    for letter, names in TAG_NAMES.items():
        kind = F.when(name.rlike(rf"^(?:{names})$"), letter).otherwise(kind)
    return kind


def tag_opens(tag: Column) -> Column:
    return ~F.startswith(tag, F.lit("/"))


#: Transitions that are walked together; over the blocks' ends the walk is one step for so many tags.
SCAN_BLOCK = 512
_BITS = len(TAG_NAMES)
_ALL_ON = (1 << _BITS) - 1


def _transition(piece: Column) -> Column:
    """What a piece's tag does to the switches: the bits it keeps, and above them the bits it sets."""
    tag = piece_tag(piece)
    name, keeps = F.ltrim(tag, F.lit("/")), F.lit(_ALL_ON)
    for i, names in enumerate(TAG_NAMES.values()):
        on = F.lit(_ALL_ON ^ 1 << i | 1 << _BITS + i)
        keeps = F.when(name.rlike(rf"^(?:{names})$"), F.when(tag_opens(tag), on).otherwise(F.lit(_ALL_ON ^ 1 << i))).otherwise(keeps)
    return keeps


def _then(first: Column, second: Column) -> Column:
    """Both transitions as one; in whatever way a row of them is grouped, the whole is the same."""
    kept = first.bitwiseAND(second).bitwiseAND(F.lit(_ALL_ON))
    still_set = F.shiftright(first, _BITS).bitwiseAND(second.bitwiseAND(F.lit(_ALL_ON)))
    return kept.bitwiseOR(F.shiftleft(F.shiftright(second, _BITS).bitwiseOR(still_set), _BITS))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _walked(steps: Column, before: Column) -> Column:
    """For each transition the one that ``before``, those in front of it and itself make. Appending copies, so steps are few."""

    def step(done: Column, one: Column) -> Column:
        return F.array_append(done, _then(F.coalesce(F.try_element_at(done, F.lit(-1)), before), one))

    return F.aggregate(steps, F.array().cast("array<int>"), step)


def _scan(steps: Column) -> Column:
    """For each transition the one that it and all before it make: blocks are composed first, then walked inside."""

    def by_blocks(steps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(SCAN_BLOCK))
        return _let(F.transform(starts, lambda start: F.slice(steps, start, F.lit(SCAN_BLOCK))), carried)

    def carried(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(_ALL_ON), _then))
        return _let(_walked(totals, F.lit(_ALL_ON)), lambda ends: inside(blocks, ends))

    def inside(blocks: Column, ends: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda block, i: _walked(block, F.coalesce(F.get(ends, i - 1), F.lit(_ALL_ON)))))

    return _let(steps, by_blocks)


def piece_states(pieces: Column) -> Column:
    """For each piece the switches that are on in it, as one bit per kind in the order of TAG_NAMES.

    A tag is a transition of the switches, and transitions compose, so the states are a prefix scan: in time
    proportional to the number of pieces, whatever the length of the page.
    """
    # Only what follows a '<' has a tag; the first piece stands before any.
    steps = F.transform(pieces, lambda piece, i: F.when(i > 0, _transition(piece)).otherwise(F.lit(_ALL_ON)))
    return F.transform(_scan(steps), lambda done: F.shiftright(done, _BITS))


def is_on(state: Column, kind: str) -> Column:
    return state.bitwiseAND(F.lit(1 << list(TAG_NAMES).index(kind))) != 0


def context(state: Column) -> Column:
    """Letters of all switches that are on, in the order of CONTEXTS; the plain letter if none is."""
    letters = F.concat(*[F.when(is_on(state, c), c).otherwise("") for c in CONTEXTS])
    return F.when(letters == "", PLAIN).otherwise(letters)
