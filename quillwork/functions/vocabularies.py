"""The three tag vocabularies with their use cases, and the scenario families. Each is a pack of one operator."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Tags:
    """Keywords by tag for feelings and ideas (any of them as a substring), use cases by feeling, further uses by idea, the use where there is none."""

    emotional: dict[str, list[str]]
    philosophical: dict[str, list[str]]
    uses: dict[str, str]
    extra_uses: dict[str, str] = field(default_factory=dict)
    default_use: str = "self-reflection"


VERSES = Tags(
    emotional={
        "anxiety": ["anxiety", "anxious", "worry", "worried", "restless"],
        "grief": ["grief", "sorrow", "sadness", "lament", "mourning"],
        "fear": ["fear", "afraid", "terror", "panic", "dread"],
        "duty": ["duty", "responsibility", "obligation", "calling"],
        "attachment": ["attachment", "attached", "clinging", "possessive"],
        "anger": ["anger", "angry", "rage", "wrath", "resentment"],
        "confusion": ["confusion", "confused", "doubt", "bewildered", "delusion"],
        "discipline": ["discipline", "practice", "restraint", "steadfast", "focus"],
        "devotion": ["devotion", "surrender", "faith", "worship", "loving service"],
        "self-control": ["self-control", "self control", "control the senses", "mastery"],
    },
    philosophical={
        "karma": ["karma", "action", "actions", "fruit of action"],
        "dharma": ["dharma", "duty", "righteousness", "sacred duty"],
        "atman": ["atman", "self", "soul", "true self"],
        "bhakti": ["bhakti", "devotion", "devotional", "surrender"],
        "jnana": ["jnana", "knowledge", "wisdom", "discernment"],
        "yoga": ["yoga", "union", "discipline", "meditation"],
        "moksha": ["moksha", "liberation", "freedom", "release"],
        "maya": ["maya", "illusion", "delusion", "appearance"],
        "guna": ["guna", "gunas", "qualities", "modes of nature"],
        "renunciation": ["renunciation", "detachment", "letting go", "non-attachment"],
    },
    uses={
        "anxiety": "coping with anxiety",
        "grief": "processing grief",
        "fear": "facing fear",
        "duty": "making duty-based decisions",
        "attachment": "letting go of attachment",
        "anger": "managing anger",
        "confusion": "finding clarity in confusion",
        "discipline": "building discipline",
        "devotion": "deepening devotion",
        "self-control": "strengthening self-control",
    },
    extra_uses={"dharma": "ethical decision-making", "karma": "reflecting on action and consequences", "yoga": "developing a spiritual practice"},
)

PASSAGES = Tags(
    emotional={
        "confusion": ["confusion", "confused", "doubt", "unknown", "bewildered"],
        "fear": ["fear", "afraid", "terror", "death", "perish"],
        "grief": ["grief", "sorrow", "lament", "mourning", "moans"],
        "desire": ["desire", "desires", "covet", "craving", "pleasant"],
        "discipline": ["discipline", "austerity", "practice", "concentration", "continence"],
        "self-control": ["self-control", "self restraint", "restrain", "senses", "collected"],
        "restlessness": ["restless", "wandering", "ramble", "agitated", "unsettled"],
        "ego": ["pride", "ego", "glory", "ours alone", "self-importance"],
        "purpose": ["purpose", "goal", "seek", "seeking", "desirable"],
        "detachment": ["detachment", "renouncing", "renunciation", "desireless", "without attachment"],
        "trust": ["trust", "faith", "rely", "teacher", "reveals"],
        "inner_steadiness": ["steady", "steadiness", "tranquility", "calm", "composed"],
    },
    philosophical={
        "atman": ["self", "atman", "soul", "inner self"],
        "brahman": ["brahman", "imperishable", "purusha"],
        "self_knowledge": ["know", "knowledge", "realize", "wisdom"],
        "non_duality": ["one", "all this is brahman", "non-dual", "unity"],
        "liberation": ["liberation", "freed", "freedom", "moksha"],
        "consciousness": ["consciousness", "mind", "intelligence", "awareness"],
        "meditation": ["meditation", "concentration", "contemplate", "om"],
        "renunciation": ["renunciation", "renounce", "desireless", "withdrawn"],
        "teacher_student": ["teacher", "disciple", "asked", "said", "instruct"],
        "death": ["death", "yama", "mortal", "immortal"],
        "immortality": ["immortal", "immortality", "eternal", "undecaying"],
        "reality": ["truth", "real", "reality", "imperishable"],
    },
    uses={
        "confusion": "finding clarity in confusion",
        "fear": "facing fear",
        "grief": "processing grief and loss",
        "desire": "working with desire and craving",
        "discipline": "building spiritual discipline",
        "self-control": "strengthening self-control",
        "restlessness": "calming mental restlessness",
        "ego": "loosening ego-driven reactions",
        "purpose": "searching for purpose",
        "detachment": "letting go of attachment",
        "trust": "learning to trust the process",
        "inner_steadiness": "finding inner steadiness",
    },
    extra_uses={"atman": "identity and self-inquiry", "death": "working with mortality and fear", "meditation": "deepening contemplative practice", "reality": "seeing beyond appearances"},
)

PRINCIPLES = Tags(
    emotional={
        "confusion": ["confusion", "confused", "doubt", "uncertain", "bewildered", "delusion"],
        "grief": ["grief", "sorrow", "sadness", "lament", "mourning", "loss"],
        "attachment": ["attachment", "attached", "clinging", "possessive", "outcome", "craving"],
        "fear": ["fear", "afraid", "dread", "terror", "panic", "anxious"],
        "duty": ["duty", "responsibility", "obligation", "righteous action", "calling"],
        "anger": ["anger", "angry", "rage", "wrath", "resentment"],
        "discipline": ["discipline", "practice", "restraint", "steadfast", "effort", "focus"],
        "devotion": ["devotion", "faith", "worship", "loving service", "prayer"],
        "self-control": ["self-control", "self control", "control the senses", "restraint", "mastery"],
        "ego": ["ego", "pride", "arrogance", "self-importance"],
        "desire": ["desire", "craving", "longing", "yearning", "lust"],
        "surrender": ["surrender", "submit", "offering", "trust completely"],
        "purpose": ["purpose", "meaning", "calling", "higher aim"],
    },
    philosophical={
        "karma": ["karma", "action", "actions", "fruit of action", "prescribed duty"],
        "dharma": ["dharma", "duty", "righteousness", "sacred duty"],
        "bhakti": ["bhakti", "devotion", "devotional", "worship", "surrender"],
        "jnana": ["jnana", "knowledge", "wisdom", "discernment", "understanding"],
        "yoga": ["yoga", "union", "discipline", "meditation", "spiritual practice"],
        "moksha": ["moksha", "liberation", "freedom", "release", "salvation"],
        "atman": ["atman", "self", "soul", "true self"],
        "guna": ["guna", "gunas", "qualities", "modes of nature"],
        "maya": ["maya", "illusion", "delusion", "appearance"],
        "renunciation": ["renunciation", "detachment", "letting go", "non-attachment"],
        "devotion": ["devotion", "faith", "worship", "loving surrender"],
        "self-realization": ["self-realization", "realize the self", "true self", "self knowledge"],
    },
    uses={
        "confusion": "finding clarity in confusion",
        "grief": "processing grief",
        "attachment": "letting go of attachment",
        "fear": "facing fear",
        "duty": "making duty-based decisions",
        "anger": "managing anger",
        "discipline": "building discipline",
        "devotion": "deepening devotion",
        "self-control": "strengthening self-control",
        "ego": "softening ego-driven reactions",
        "desire": "working with desire wisely",
        "surrender": "practicing surrender",
        "purpose": "reconnecting with purpose",
    },
    extra_uses={"karma": "reflecting on action and consequences", "dharma": "ethical decision-making", "self-realization": "deep self-inquiry"},
)

#: Family: (ideas, feelings). Spelled with low lines, as tags are normalised.
FAMILIES = {
    "career": (["duty", "karma", "purpose", "attachment"], ["confusion", "fear", "purpose"]),
    "relationship": (["attachment", "trust", "detachment", "devotion"], ["attachment", "anger", "fear", "ego", "trust"]),
    "discipline": (["discipline", "meditation", "teacher_student", "self_knowledge"], ["discipline", "restlessness", "self_control", "desire"]),
    "fear_change": (["death", "immortality", "trust", "liberation"], ["fear", "grief", "trust", "inner_steadiness"]),
    "attachment": (["renunciation", "detachment", "dharma", "karma"], ["attachment", "desire", "fear", "detachment"]),
    "purpose": (["self_knowledge", "atman", "brahman", "non_duality", "reality", "consciousness", "liberation"], ["purpose", "confusion", "inner_steadiness"]),
    "self_control": (["discipline", "meditation", "renunciation"], ["self_control", "anger", "desire", "discipline", "restlessness"]),
    "inner_conflict": (["self_knowledge", "teacher_student", "non_duality", "reality"], ["confusion", "ego", "desire", "inner_steadiness", "fear"]),
}
FALLBACK_FAMILIES = ["inner_conflict", "purpose", "discipline", "attachment", "career"]

#: Teaching texts: what rules a text out, and phrases that are taken out of it.
TEACHING_FORBIDDEN = r"the central lesson is|my bow|gandeeva|arjuna|krishna said|sanjaya|o king|o partha|chapter\s+\d+|\d+\.\d+"
TEACHING_FALLBACK = r"my teachings|follow my teachings|attain salvation|living being cannot perform|perform your prescribed dut(?:y|ies)|for others independently|worship me|devotee|supreme lord"
TEACHING_PHRASES = ["I hear", "Begin by slowing the mind", "A helpful reflection", "Let this teaching", "The central lesson is"]

#: The cleanup of answers.
CLEANUP_SCRIPTURE = "gita|upanishad|chapter|passage|verse|krishna|arjuna|kena|katha|mundaka"
CLEANUP_STARTS = ["that becomes practical when", "that becomes useful when", "that becomes real when"]
CLEANUP_HINTS = [
    "write down", "choose one", "set a short timer", "pause and ask", "take ten quiet minutes", "pick one", "name one", "breathe slowly", "practice one", "remove one", "interrupt", "return to",
    "meet it with one calm deliberate action", "reverse that pattern", "do it at a fixed time", "complete one gentle grounding act", "begin it before your mood improves",
]
