"""One sentence for each entry: ordered rule lists, a cascade over tags, and sentences made to stand alone."""

from __future__ import annotations

from quillwork.functions import packs as P
from quillwork.functions import text as X
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect
from quillwork.plans.lesson_queries import joined

# Own wording, by what a rule is about.
LINES = {
    "doubt": "Strong feeling makes able people doubt what they know.", "outcome": "Work on the act and leave its outcome.", "calling": "The work that is yours makes the way plain.", "desire": "A desire shrinks when it no longer chooses for you.",
    "anger": "Anger harms less when it has to wait.", "practice": "A restless mind is trained by small repeated steps.", "self_control": "Guide an impulse and it will carry you.", "devotion": "Devotion is measured by sincerity and not by show.",
    "grief": "Let sorrow have its hour and its end.", "fear": "Do the right thing while the fear is still there.", "attachment": "Open the hand that cannot keep what it holds.", "path": "The way one walks decides where one arrives.",
    "knowledge": "Clear sight is earned by patient attention.", "family": "What one neglects is paid for by many.", "space": "What holds everything is stained by nothing.", "balance": "Meet gain and loss with the same face.",
    "freedom": "Freedom begins where clinging ends.", "discipline": "Steady habits hold when feelings do not.", "surrender": "Give your effort and ask for no promise.", "purpose": "An aim beyond yourself makes the steps clear.", "truth": "Return to what is true and confusion starves.",
    "humility": "Some truths open to humility and not to argument.", "long_view": "Prefer what is good for long to what is pleasant now.", "comfort": "When comfort stops deciding, desire grows quiet.", "awareness": "You are more than what you sense and think.", "change": "Fear loosens when change is no longer loss.",
    "release": "Peace rests on nothing that must pass.", "honesty": "Honest sight unties the heart.", "pride": "Pride hides best inside success.",
}

# The patterns of the two rule lists in their order, as whole words.
VERSE_RULES = [
    ("bow|limbs|skin is burning|unable to stand|delusion|doubt", "doubt"),
    ("expectation|expectations|outcomes?|fruit of action|results?", "outcome"),
    ("prescribed dut|natural attributes|responsibilit|calling", "calling"),
    ("desire|craving|lust|sense pleasures?", "desire"),
    ("anger|wrath|resentment|rage", "anger"),
    ("wandering mind|restless mind|control the mind|meditation|practice", "practice"),
    ("control the senses|sense organs|self-control|restraint|mastery", "self_control"),
    ("devotion|worship|faith|surrender|loving service", "devotion"),
    ("grief|sorrow|lament|mourning|loss", "grief"),
    ("fear|afraid|terror|panic|dread", "fear"),
    ("attachment|attached|clinging|possessive|letting go", "attachment"),
    ("paths taken|return to this world|not return|seekers", "path"),
    ("knowledge|wisdom|discernment|understanding", "knowledge"),
    ("famil(?:y|ies)|unrighteousness|sinful acts|perils", "family"),
    ("space|tainted|pervading everywhere", "space"),
    ("success and failure|equanimity|balanced mind", "balance"),
    ("liberation|freedom|release", "freedom"),
]
PASSAGE_RULES = [
    ("argument|arguable|cannot be had through argumentation", "humility"),
    ("preferable|pleasant|desirable|covetable", "long_view"),
    ("desire|wealth|ephemeral|craving", "comfort"),
    ("ear of the ear|mind of the mind|eye of the eye", "awareness"),
    ("immortal|immortality|death|mortal", "change"),
    ("desireless|without attachment|freed from attachment|renouncing", "release"),
    ("knot of the heart|doubts become solved", "honesty"),
    ("victory|pride|glory", "pride"),
]
# Fixed values: (feelings, ideas) of which one must be there, in order; the second entry needs both sides.
CASCADE = [
    (["confusion", "fear"], [], "doubt"), (["duty"], ["karma", "dharma"], "outcome"), (["attachment"], [], "attachment"), (["anger"], [], "anger"), (["discipline"], ["yoga"], "discipline"), (["self-control"], [], "self_control"), (["desire"], [], "desire"),
    (["devotion"], ["bhakti"], "devotion"), (["surrender"], [], "surrender"), (["purpose"], ["dharma"], "purpose"), ([], ["jnana", "atman"], "truth"),
]
SPEAKER = "arjuna|krishna|sanjaya|dhritarashtra|gandeeva|partha|madhusudana|kaunteya"
NARRATION = r"(?i)^(o king|o partha|arjuna said|sanjaya said|krishna said|the lord said)($|[^\p{L}\p{N}_])"
TERMS = "karma|dharma|atman|bhakti|jnana|moksha|maya|guna|yoga|samsara|rajas|tamas|sattva"
FIRST_PERSON = "i|my|me|we|our|us"
QUESTION = r"(?i)[?]|^(what|how|why|when)($|[^\p{L}\p{N}_])"
ASIDES = "this verse|the lord|the selfsame|therefore"


def rule_of(d: Dialect, low: str, rules: list[tuple[str, str]]) -> str:
    """The name of the first rule whose pattern stands in the text; null if none does."""
    return "CASE " + " ".join(f"WHEN {d.rx(low, P.words(p))} THEN {d.lit(name)}" for p, name in rules) + " END"


def line_of(d: Dialect, name: str) -> str:
    return "CASE " + " ".join(f"WHEN {name} = {d.lit(k)} THEN {d.lit(v)}" for k, v in LINES.items()) + " END"


def by_tags(d: Dialect) -> str:
    em, ph = (lambda tags: d.overlap(f"coalesce(emotional_tags, {d.array([])})", d.strings(tags))), (lambda tags: d.overlap(f"coalesce(philosophical_tags, {d.array([])})", d.strings(tags)))
    whens = []
    for i, (feelings, ideas, name) in enumerate(CASCADE):
        sides = [x for x in (em(feelings) if feelings else None, ph(ideas) if ideas else None) if x]
        whens.append(f"WHEN {(' AND ' if i == 1 else ' OR ').join(sides)} THEN {d.lit(name)}")
    return f"CASE {' '.join(whens)} END"


def without(d: Dialect, e: str, alternatives: str) -> str:
    """The text without some words; taken out twice, since neighbours share the sign between them."""
    once = lambda x: d.sub(x, P.words(alternatives), "{1}{2}")
    return once(once(e))


def standing(d: Dialect, source: str, sentences: str) -> str:
    """source with alone: the first of its sentences that can be made to stand alone, or the line that it calls for."""
    rx = lambda e, p: d.rx(e, P.words(p))
    has = lambda e, *ws: "(" + " OR ".join(f"contains(lower({e}), {d.lit(w)})" for w in ws) + ")"
    kept = d.filt(sentences, "s", f"{d.size(X.tokens(d, 's'))} >= 6 AND NOT {d.rx('s', QUESTION)} AND NOT {rx('s', FIRST_PERSON)} AND NOT {d.rx('s', NARRATION)}")
    stripped = d.sub(X.clean_text(d, without(d, d.sub(without(d, "s", TERMS), r"\([^)]*\)", ""), ASIDES)), r"^[ .,:;-]+|[ .,:;-]+$", "")
    # a sentence that names a speaker is marked, others are stripped
    first = f"CASE WHEN {rx('s', SPEAKER)} THEN CASE WHEN {has('s', 'doubt', 'delusion', 'fear')} THEN '=doubt' WHEN {has('s', 'duty', 'action', 'fruit')} THEN '=outcome' ELSE '' END ELSE {stripped} END"
    capped = f"CASE WHEN {d.size(X.tokens(d, 'u'))} > 30 THEN concat({d.sub(d.join(d.slice(X.tokens(d, 'u'), 1, 30), ' '), '[.,;:]+$', '')}, '.') ELSE concat(u, '.') END"
    invalid = " OR ".join([d.rx("u", P.AUDIT_CORRUPTION), d.rx("u", NARRATION), d.rx("u", QUESTION), rx("u", FIRST_PERSON), rx("u", SPEAKER), rx("u", TERMS)])
    cases = [
        "WHEN u = '' THEN NULL", "WHEN substr(u, 1, 1) = '=' THEN u", f"WHEN {rx('u', FIRST_PERSON)} OR {d.rx('u', QUESTION)} THEN NULL", f"WHEN {has('u', 'my bow', 'my limbs', 'my skin', 'battlefield')} THEN '=doubt'", f"WHEN {has('u', 'outcome', 'fruit of action')} THEN '=outcome'",
        f"WHEN {has('u', 'control the senses', 'restraint')} THEN '=self_control'", f"WHEN {has('u', 'anger')} THEN '=anger'", f"WHEN {has('u', 'fear')} THEN '=fear'", f"WHEN {has('u', 'teach you', 'i will now', 'great warriors', 'possessing heavy weapons', 'surviving women')} THEN NULL", f"WHEN {invalid} THEN NULL",
    ]
    final = f"CASE {' '.join(cases)} ELSE concat(upper(substr(u, 1, 1)), substr({capped}, 2)) END"
    s = f"SELECT *, {d.trans(kept, 's', first)} AS c1 FROM ({source}) w0"
    s = f"SELECT *, {d.el(d.filt(d.trans('c1', 'u', final), 'v', 'v IS NOT NULL'), 1)} AS found FROM ({s}) w1"
    return f"SELECT *, CASE WHEN substr(found, 1, 1) = '=' THEN {line_of(d, 'substr(found, 2)')} ELSE found END AS alone FROM ({s}) w2"


def candidates(d: Dialect) -> str:
    of = lambda t: f"coalesce({d.sentences(X.clean_text(d, t))}, {d.array([])})"
    return d.nonblank(d.cat(d.cat(of("extracted_principle"), of("translation")), of("commentary")))


def first_match_rule(d):
    """The first rule of either list that the text of an entry meets, with the line it gives."""
    low = joined(d, "extracted_principle", "translation", "commentary")
    s = f"SELECT id, {rule_of(d, 'low', VERSE_RULES)} AS verse_rule, {rule_of(d, 'low', PASSAGE_RULES)} AS passage_rule FROM (SELECT id, {low} AS low FROM {current(d, 'wisdom_entries')} e) q"
    return f"SELECT id, verse_rule, {line_of(d, 'verse_rule')} AS verse_line, passage_rule, {line_of(d, 'passage_rule')} AS passage_line FROM ({s}) r"


def tag_cascade(d):
    return f"SELECT id, tag_rule, {line_of(d, 'tag_rule')} AS line FROM (SELECT id, {by_tags(d)} AS tag_rule FROM {current(d, 'wisdom_entries')} e) q"


def universalise(d):
    """The first sentence of principle, translation and commentary that can be made to stand alone."""
    return f"SELECT id, alone AS universal FROM ({standing(d, f'SELECT id, {candidates(d)} AS ss FROM {current(d, "wisdom_entries")} e', 'ss')}) q"


def distil_entries(d):
    """Nothing from corrupt text; else the line of the first rule, that of the tags, or the first sentence that can stand alone."""
    bad = " OR ".join(f"coalesce({d.rx(c, P.AUDIT_CORRUPTION)}, false)" for c in ("translation", "commentary"))
    low = joined(d, "extracted_principle", "translation", "commentary")
    s = f"SELECT id, {bad} AS bad, {by_tags(d)} AS tag_rule, {low} AS low, {candidates(d)} AS ss FROM {current(d, 'wisdom_entries')} e"
    s = f"SELECT *, {rule_of(d, 'low', VERSE_RULES)} AS rule FROM ({s}) q0"
    return f"SELECT id, CASE WHEN bad THEN NULL ELSE coalesce({line_of(d, 'rule')}, {line_of(d, 'tag_rule')}, alone) END AS distilled FROM ({standing(d, s, 'ss')}) q"


QUERIES = {f.__name__: f for f in (first_match_rule, tag_cascade, universalise, distil_entries)}
