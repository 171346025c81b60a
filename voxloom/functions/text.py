r"""Column functions on text, paths and numbers; all built-in expressions, so they stay in generated code.

Character classes are spelled out (``[\p{L}\p{N}_]`` for word characters, SPACES for white space) because the
short forms mean different sets in different regex engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in a character class, as Java and RE2 both read it.
SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\p{L}\p{N}_"

#: The same white space as characters, and what F1 drops of ASCII.
SPACE_CHARS = "".join(map(chr, (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
ASCII_DROPPED = "".join(c for c in map(chr, range(128)) if not (c.isalnum() or c == "_" or c in SPACE_CHARS))

#: Seconds a word by language, and limits.
SECONDS_PER_WORD = {"en": 0.35, "de": 0.45, "nl": 0.35}
DEFAULT_SECONDS_PER_WORD = 0.35
MAX_SECONDS_PER_WORD = 0.8
CALIBRATED_MARGIN = 2.5
WORDS_PER_MINUTE = 150
SAMPLE_BYTES_PER_SECOND = 16_000

#: Emotions after which a listener reacts, and the words of each reaction.
SURPRISE_EMOTIONS = ("surprised", "excited", "passionate", "emphatic", "fascinated")
AGREEMENT_EMOTIONS = ("warm", "calm", "thoughtful", "explaining", "building")
REACTIONS = {"agreement": ("mmhm", "right", "yeah"), "surprise": ("oh", "huh", "wow"), "tracking": ("right", "mmhm", "okay")}
CLIP_WORDS = {"agreement": ("Mmhm.", "Right.", "Yeah.", "Mm."), "surprise": ("Huh.", "Oh.", "Wow."), "tracking": ("Right.", "Okay.", "Right, right.", "Yeah, yeah.")}

#: Names of languages.
LANGUAGES = {"en": "English", "nl": "Dutch", "de": "German", "fr": "French", "es": "Spanish"}


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^[{SPACES}]+|[{SPACES}]+$", "")


def _split(text: Column) -> Column:
    """What lies between spaces."""
    return F.array_remove(F.split(text, " "), "")


def normal_words(text: Column) -> Column:
    """The words of F1's text.  One ``translate`` cleans ASCII and makes white space plain; only a text with other letters meets the regular expression."""
    low = F.translate(F.lower(text), SPACE_CHARS + ASCII_DROPPED, " " * len(SPACE_CHARS))
    return _split(F.when(F.octet_length(low) == F.length(low), low).otherwise(F.regexp_replace(low, f"[^{WORD} ]", "")))


def normalize_text(text: Column) -> Column:
    """lower case, punctuation dropped, white space collapsed."""
    return F.array_join(normal_words(text), " ")


def word_count(text: Column) -> Column:
    """F2; 0 for empty and null texts.  Split like ``normal_words``: to count a regular expression's matches costs seven times as much."""
    return F.when(text.isNotNull(), F.size(_split(F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))))).otherwise(0)


def sentence_count(text: Column) -> Column:
    """runs of sentence marks."""
    return F.coalesce(F.regexp_count(text, F.lit("[.!?]+")), F.lit(0))


def backchannel_type(text: Column, emotion: Column) -> Column:
    """the listener's reaction to a line, or null."""
    return (
        F.when(F.regexp_replace(text, f"[{SPACES}]+$", "").endswith("?"), "agreement")
        .when(emotion.isin(*SURPRISE_EMOTIONS), "surprise")
        .when(sentence_count(text) >= 3, "tracking")
        .when(emotion.isin(*AGREEMENT_EMOTIONS) & (word_count(text) > 15), "agreement")
    )


def max_duration(words: Column, seconds_per_word: Column) -> Column:
    """the longest plausible duration of a line."""
    return F.coalesce(words * seconds_per_word * CALIBRATED_MARGIN, words * MAX_SECONDS_PER_WORD)


def calibrated_rate(duration: Column, words: Column) -> Column:
    """seconds a word of a reference; null below three words."""
    return F.when(words >= 3, F.try_divide(duration, words))


def word_seconds(language: Column) -> Column:
    """the planning rate of a language."""
    known = F.create_map(*(F.lit(x) for kv in SECONDS_PER_WORD.items() for x in kv))
    return F.coalesce(F.try_element_at(known, language), F.lit(DEFAULT_SECONDS_PER_WORD))


def duration_ratio(duration: Column, words: Column, language: Column) -> Column:
    """actual over expected duration, which is at least a tenth of a second."""
    return duration / F.greatest(words * word_seconds(language), F.lit(0.1))


def srt_time(ms: Column) -> Column:
    """F8: ``HH:MM:SS,mmm``; hours may have more than two digits."""
    part = lambda x, n: F.when(F.length(x) < n, F.lpad(x, n, "0")).otherwise(x)
    whole = lambda a: F.floor(a).cast("long").cast("string")
    return F.concat(part(whole(ms / 3_600_000), 2), F.lit(":"), part(whole(ms % 3_600_000 / 60_000), 2), F.lit(":"), part(whole(ms % 60_000 / 1000), 2), F.lit(","), part(whole(ms % 1000), 3))


def gain_db(current: Column, target: float) -> Column:
    """F9."""
    return F.lit(target) - current


def db_to_linear(db: Column) -> Column:
    """F10."""
    return F.pow(F.lit(10.0), db / 20)


def to_samples(seconds: Column, rate: int) -> Column:
    """truncated towards zero."""
    return (seconds * rate).cast("long")


def shorten(text: Column, width: int = 80, mark: str = "...") -> Column:
    """whole words only, with a mark where some are left out."""
    flat = strip(F.regexp_replace(text, f"[{SPACES}]+", " "))
    head = F.regexp_extract(flat, f"^(.{{0,{width - len(mark)}}})(?: |$)", 1)
    return F.when(F.length(flat) <= width, flat).otherwise(F.concat(F.regexp_replace(head, " +$", ""), F.lit(mark)))


def title_from_stem(stem: Column) -> Column:
    """F13."""
    return F.initcap(F.translate(stem, "_-", "  "))


def line_key(index: Column) -> Column:
    """at least three digits."""
    return F.format_string("%03d", index)


def path_rejected(path: Column) -> Column:
    """F16: absolute, or with a parent step."""
    return F.startswith(path, F.lit("/")) | F.array_contains(F.split(path, "/"), "..")


def voice_register(f0: Column) -> Column:
    """F17."""
    return F.when(f0.isNull(), "").when(f0 < 165, "Low").when(f0 < 255, "Mid").otherwise("High")


def cast_names(cast: Column) -> Column:
    """trimmed, capitalised names of a comma-separated list."""
    names = F.transform(F.split(cast, ","), lambda x: F.trim(x))
    return F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1_000_000))))


def cast_roles(cast: Column) -> Column:
    """(name, role) of two or three names; null for other numbers."""
    names, roles = cast_names(cast), F.array(F.lit("host"), F.lit("expert"), F.lit("source voice"))
    zipped = F.transform(names, lambda x, i: F.struct(x.alias("name"), F.get(roles, i).alias("role")))
    return F.when(F.size(names).between(2, 3), zipped)


def word_target(minutes: Column) -> Column:
    """F19."""
    return minutes * WORDS_PER_MINUTE


def sample_minutes(words: Column) -> Column:
    """how long a voice sample's text takes to say."""
    return words / WORDS_PER_MINUTE


def sample_seconds(size: Column) -> Column:
    """how long a recorded sample is, by its bytes at 128 kbit/s."""
    return size / SAMPLE_BYTES_PER_SECOND


def language_name(code: Column) -> Column:
    """the code itself where it is unknown."""
    known = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, code), code)


def language_matches(detected: Column, expected: Column) -> Column:
    """by the first two letters."""
    return F.lower(F.left(detected, F.lit(2))) == expected


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is next to nothing."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm < 1e-10, 0.0).otherwise(dot(a, b) / norm)


def argument_issue(noise_db: Column, min_duration: Column, speaker_db: Column) -> Column:
    """what is out of range, or null."""
    return (
        F.when(~noise_db.between(-100, 0), "noise_db")
        .when(~min_duration.between(0.01, 10), "min_duration")
        .when(~speaker_db.between(-30, 30), "speaker_db")
    )


def full_volume(volume: Column) -> Column:
    """F26."""
    return F.least(3 * volume, F.lit(0.4))


def fade_start(duration: Column, fade: Column) -> Column:
    """F26."""
    return F.greatest(F.lit(0.0), duration - fade)


def slug(name: Column) -> Column:
    """P10: a file-name part of a section's name."""
    bare = F.regexp_replace(F.lower(F.replace(name, F.lit(" "), F.lit("_"))), r"[^a-z0-9_\-]", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("section"))


def safe_filename(name: Column) -> Column:
    """P11."""
    return F.regexp_replace(name, f"[^{WORD}]", "_")


def preview(text: Column, width: int = 80) -> Column:
    """SK11: the first characters, marked where more follow."""
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def html_text(html: Column) -> Column:
    """SC3: the text of a page: scripts, styles, navigation, comments and tags dropped, entities resolved."""
    out = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</(script|style|nav|head)>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    for entity, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(letter))
    return strip(F.regexp_replace(out, f"[{SPACES}]+", " "))


def uniform_bits(*parts: Column | str | int) -> Column:
    """A counter-based random number from 0 to 2**32 - 1: a hash of its place, so every engine and task draws the same."""
    text = F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def chance(bits: Column, probability: float) -> Column:
    """Whether a draw falls below a probability."""
    return bits < F.lit(int(probability * 2**32))


def between(bits: Column, low: Column, high: Column) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return low + bits % (high - low + 1)


def ms(seconds: Column) -> Column:
    """Whole milliseconds, halves up; the same in every IEEE engine."""
    return F.floor(seconds * 1000 + 0.5).cast("long")
