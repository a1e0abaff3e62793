"""Patterns, phrases and banks: parameters of the text functions and rule packs.

They are worded for the test tables; each pack takes others in their place.
"""

METADATA = r"(page|chapter) \d+|\d+\.\d+"
CORRUPTION = r"[�¤]|[|]{2}|\?\?"
BOILERPLATE = r"(?i)(^|[^\p{L}])(copyright|license|printed in|all rights)([^\p{L}]|$)"
STOP_PHRASES = ["it helps to ask", "the old teaching", "what you call"]
UNSAFE = r"(?i)(^|[^\p{L}])(stop your medicine|hurt yourself|never see a doctor)([^\p{L}]|$)"
MEDICAL = r"(?i)(^|[^\p{L}])(diagnosis|medicine|dose|therapy)([^\p{L}]|$)"
PREACHY = r"(?i)(^|[^\p{L}])(you must|never yours|cannot)([^\p{L}]|$)"
NARRATION = r"(?i)(^|[^\p{L}])(said|asked|answered|spoke)([^\p{L}]|$)"
LESSON = r"(?i)(^|[^\p{L}])(mind|self|heart|teach|learned|sees)([^\p{L}]|$)"
CONFLICT = r"(?i)(^|[^\p{L}])(anger|fear|grief|envy|doubt|worry|sorrow|pride|desire)([^\p{L}]|$)"
ACTION = r"(?i)(^|[^\p{L}])(write|walk|name|ask|choose|begin|take|keep|read|let|put|finish|close|return)([^\p{L}]|$)"
LISTICLE = r"(?m)^\s*([-*•]|\d+[.)])\s"
HEADER = r"(?i)^(chapter|page|verses|songs|notes) "
SPEAKER = r"^[A-Z][a-z]+( [a-z]+)? (said|answered|asked)"
GENERIC = r"(?i)(everything happens|just be yourself|one day at a time|in the end)"
FORBIDDEN = ["as an ai", "language assistant", "guidelines"]
SCAFFOLD = ["it helps to ask", "the old teaching", "what you call", "begin with", "notice how"]
CONCRETE = ["phone", "letter", "tea", "room", "road", "ledger", "page"]
TIME_PHRASE = r"(?i)(tonight|tomorrow|each day|this week|before noon|until morning)"
EMPATHY = r"(?i)(i'm sorry that|it is hard|you carry|i hear)"
FEELING = ["afraid", "guilty", "lonely", "angry", "sad", "ashamed"]
CALM = ["calm", "quiet", "patient", "gentle", "still", "slow", "breath"]
PHILOSOPHY = ["self", "mind", "freedom", "duty", "truth", "attachment", "desire", "wisdom"]
SCRIPTURE = ["scripture", "teaching", "verse", "scribe"]
TRUE_MARKERS = ["mind", "self", "teach", "heart", "witness"]
DIACRITICS = "[āīūṛṝśṣṭḍṇṅñṃḥ]"

EMOTIONAL = {"anger": ["anger", "furious"], "fear": ["fear", "afraid", "worry"], "grief": ["grief", "sorrow", "loss"], "envy": ["envy", "jealous"], "doubt": ["doubt", "confusion"], "pride": ["pride", "vanity"], "hope": ["hope", "trust"], "loneliness": ["lonel"]}
PHILOSOPHICAL = {"detachment": ["detach", "renunciation", "surrender"], "duty": ["duty", "obligation", "responsib"], "self_knowledge": ["self", "witness"], "desire": ["desire", "craving", "longing"], "wisdom": ["insight", "discernment", "understand"], "practice": ["discipline", "practi", "steadi"]}
USE_CASES = {"anger": "conflict", "fear": "courage", "grief": "mourning", "envy": "comparison", "doubt": "decision", "pride": "humility", "hope": "encouragement", "loneliness": "belonging"}
DEFAULT_USE = "reflection"
EMOTION_WORDS = {"anger": "heat", "fear": "unease", "grief": "weight", "envy": "comparison", "doubt": "fog"}
FOCUS_WORDS = {"detachment": "release", "duty": "task", "self_knowledge": "seeing", "desire": "wanting", "wisdom": "judgement"}
ACTION_FAMILIES = {"duty": "begin", "practice": "repeat", "detachment": "let go", "desire": "wait", "self_knowledge": "look"}
SCENARIOS = [("inner_conflict", ["anger", "envy", "pride"]), ("loss", ["grief", "loneliness"]), ("decision", ["doubt", "fear"])]
FIRST_MATCH = [(r"(?i)anger|furious", "Pause before anger speaks for you."), (r"(?i)grief|sorrow", "Let sorrow have its hour and its end."), (r"(?i)desire|craving", "Watch a desire before you follow it."), (r"(?i)duty|obligation", "Do the duty and leave its fruit."), (r"(?i)fear|worry", "Take one step while the fear is still there.")]
PHRASE_MAP = {"it helps to ask": "ask", "in front of you": "before you", "comes back to mind": "returns"}
FAMILIES = {"work": (["duty", "practice"], ["fear", "doubt"]), "family": (["detachment"], ["anger", "grief"]), "self_worth": (["self_knowledge"], ["envy", "pride"]), "change": (["wisdom", "desire"], ["grief", "hope"]), "solitude": (["self_knowledge", "detachment"], ["loneliness"])}
FALLBACK_FAMILIES = ["change", "work", "family", "self_worth"]
TEMPLATES = ["How do I meet {x}", "What helps with {x}", "Where does {x} end"]
CONTEXTS = ["at work", "at home", "among friends", "alone"]
TAILS = ["today?", "without haste?", "and stay kind?", "after a hard week?", "before I sleep?"]
CLOSERS = ["Go gently.", "This is enough for today.", "Begin small."]
SYSTEM_PROMPT = "You answer plainly and kindly."
REPLACED_PROMPT = "You are a calm guide. Give one practical step."
