"""Values that results depend on, stated once."""

# Terms whose presence anywhere in a text makes it unsafe for work.
BLOCKED_TERMS = (
    "cock", "cocks", "cum", "cumming", "blowjob", "handjob", "cunt", "pussy",
    "anal", "creampie", "deepthroat", "gangbang", "bukkake", "fellatio",
    "cunnilingus", "masturbat", "orgasm", "ejaculat", "clitor", "dildo",
    "porn", "pornhub", "xxx", "nsfw", "titties", "boobs",
    "fuck", "fucking", "fucked", "fucker", "motherfucker",
    "nigger", "nigga", "faggot", "retard", "chink", "kike", "tranny", "coon",
)

# Keyword patterns of dramatic prose, each between word boundaries.
DRAMA_PATTERNS = (
    r"betray\w*", "affair", r"cheat\w*", "mistress", "lover", r"adulter\w*", r"secret\w*", "revenge",
    r"vengean\w*", "marriage", "married", "divorce", r"widow\w*", r"pregnan\w*", r"inherit\w*",
    "scandal", r"confess\w*", r"jealous\w*", r"deceiv\w*", "lie[sd]?", "betrothed", r"scheme\w*",
    "twist", r"reveal\w*", "blackmail", "funeral", r"murder\w*", "wedding", "husband", "wife",
    r"fianc\w*", r"heir\w*", "estate", "dynasty", "family",
)

# Speaker names of the asking and of the answering side.
USER_ROLES = ("human", "user", "prompter")
ASSISTANT_ROLES = ("gpt", "assistant", "chatgpt", "bot")

# Genres that are let in, and the categories of the two screenplay slices.
GENRES = ("drama", "romance", "psychological", "thriller", "mystery", "crime", "noir", "historical", "biopic", "war", "horror")
VOICE_CATEGORIES = ("dialogue_craft", "ensemble_scene", "scene_writing", "monologue", "exposition_scene", "closing_image", "opening_image", "character_generation", "transition_scene")
STRUCTURE_CATEGORIES = ("storyline_generation", "structure_analysis", "act_break", "series_bible", "pitch_document", "tv_pilot", "script_coverage")

# Slices in build order with their caps, scan limits, prompts and licenses.
SLICES = (
    ("fruit_synth", 7500, None, "fruit", "ours"),
    ("screenplay_voice", 8000, 260000, "voice", "mit"),
    ("screenplay_structure", 3000, 260000, "voice", "mit"),
    ("multichar", 13000, 20000, "voice", "cc-by-4.0"),
    ("dramabench", 1100, 2000, "voice", "mit"),
    ("gutenberg_melodrama", 3000, 800, "voice", "public-domain"),
    ("writingprompts_twist", 30000, 280000, "voice", "mit"),
)

# Prompts that adapters write.
SCENE_PROMPT = "Write a dramatic multi-character scene as screenplay dialogue."
CONTINUE_PROMPT = "Continue this dramatic script in the same voice."
MELODRAMA_PROMPT = "Write an emotionally charged dramatic scene in the style of classic melodrama, rich with dialogue and rising tension."
TWIST_PROMPT = "Write a dramatic short story with a shocking plot twist based on this prompt:\n\n"

# Life stages of a character and their labels.
STAGES = (
    ("growth", "Growth (green / young)"),
    ("prime", "Prime (ripe / peak)"),
    ("ripening", "Ripening (the fall begins)"),
    ("senescence", "Senescence (rotten / failure)"),
)

# Choices for a cast.
ROLES = (
    "Yoga instructor", "Gym bro / trainer", "CEO / mogul", "Housewife / househusband", "Detective", "Doctor / surgeon", "Lawyer", "Chef", "Influencer", "Bartender",
    "Politician", "Priest / pastor", "Teacher", "Nurse", "Model", "Retired pro athlete", "Mob boss", "Heir / heiress", "Maid / butler", "Bodyguard",
    "Artist", "Pop star", "Nanny", "Real-estate mogul", "Wedding planner", "Pilot", "Farmer", "Fortune teller", "Bride", "Groom",
    "Mistress", "Mother-in-law", "The ex", "Long-lost twin", "Con artist", "Socialite", "Personal trainer", "Bouncer", "Barista", "Fashion designer",
)
DISPOSITIONS = (
    "Hot and arrogant", "Shy and sweet", "Cold and calculating", "Warm but naive", "Secretly rich", "Secretly broke", "Vengeful", "Heartbroken", "Ambitious", "Jealous",
    "Loyal to a fault", "Two-faced", "Seductive", "Insecure", "Ruthless", "Protective", "Manipulative", "Righteous", "Reckless", "Hiding a secret",
    "Newly pregnant", "Recently betrayed", "Power-hungry", "Desperate for approval", "Cool and detached", "Disciplined", "Haunted by the past", "Overconfident",
)
CHARACTERS = (
    "Protagonist", "Antagonist / Villain", "Temptress / Seducer", "Innocent victim", "Matriarch / Patriarch", "The Heir", "The Betrayer", "The Peacemaker", "The Schemer", "Comic relief",
    "The Wildcard", "The Mentor", "The Outsider", "The Golden child", "The Black sheep", "The Gossip", "The Enforcer", "The Martyr", "The Trophy", "The Underdog",
)

#: Label of tokens that a loss ignores.
IGNORED = -100
