"""Tables of the episode generator.

Templates name the draws of their plot in braces: ``{x}`` is the appearance of slot x,
``{x^}`` the same capitalised, ``{twist}`` the drawn twist.
"""

# Archetypes with the appearances and signature items of their characters.
CAST = {
    "matriarch": (("an elderly broccoli woman", "a silk ivory robe and a pearl necklace"), ("a silver-haired broccoli matriarch", "a lace shawl and heirloom pearls"), ("a stern broccoli grandmother", "a high-collared black gown and a jade brooch")),
    "villain": (("a tall grape man", "a tailored black suit and a gold signet ring"), ("a sleek eggplant man", "a dark velvet blazer and a diamond cufflink"), ("a sharp-eyed grape woman", "a charcoal power suit and blood-red nails")),
    "temptress": (("a young strawberry woman", "a red silk dress and crimson lipstick"), ("a glamorous cherry woman", "a scarlet gown and ruby earrings"), ("a radiant strawberry woman", "a plunging wine-colored dress and gold hoops")),
    "innocent": (("a gentle banana man", "a plain linen shirt and a simple wristband"), ("a soft-spoken corn woman", "a cream cardigan and a thin silver locket"), ("a kind-eyed banana man", "a beige sweater and round glasses")),
    "heir": (("a young avocado man", "a sharp navy suit and a gold watch"), ("an ambitious bell-pepper woman", "a tailored red blazer and a slim briefcase"), ("a brooding avocado man", "an unbuttoned tuxedo and a silver signet ring")),
}

# Settings (place, time of day, light) and moods.
SETTINGS = (
    ("a luxurious penthouse living room", "at night", "warm lamplight and long shadows"),
    ("an elegant marble bathroom", "in the early morning", "soft golden light"),
    ("an upscale restaurant booth", "late at night", "flickering candlelight"),
    ("a sprawling vineyard estate", "at dusk", "amber sunset haze"),
    ("a sterile hospital corridor", "after midnight", "cold blue fluorescent light"),
    ("a grand ballroom mid-wedding", "in the evening", "glittering chandelier light"),
    ("a glass-walled corporate boardroom", "at night", "harsh overhead light"),
    ("a moonlit garden gala", "at night", "silver moonlight and string lights"),
    ("a rain-streaked limousine", "at night", "passing streetlights"),
    ("a family mansion's grand staircase", "at dusk", "dim golden sconces"),
)
MOODS = ("tense", "suspicious", "heartbroken", "furious", "intimate and secretive", "cold and confrontational", "devastated", "triumphant and cruel")

# Wordings of the request; {n} is the episode, {logline} the plot's.
REQUESTS = (
    "Write episode {n} of an AI fruit drama. Logline: {logline}",
    "New fruit-drama episode ({n}). {logline} End on a cliffhanger.",
    "Give me a 6-scene AI fruit drama script. {logline}",
    "Episode {n}, please. Premise: {logline} Make it as shareable as possible.",
    "Fruit drama, episode {n}. {logline} Keep it platform-safe but scandalous.",
)

# Names of the six scenes.
LABELS = ("Recap", "Rising Tension", "Rising Tension", "Dramatic Peak", "Dramatic Peak", "Cliffhanger")

# Plots. slots: draw -> archetypes it may come from. beats: narration, who is
# seen, where ("s": the plot's setting, "*": one drawn for the scene, a number: that setting), what they do.
PLOTS = {
    "infidelity": {
        "slots": {"betrayed": ("innocent", "matriarch"), "cheater": ("temptress",), "lover": ("villain", "heir")},
        "title": "The Affair at Midnight",
        "logline": "{cheater^}'s affair with {lover} is uncovered by {betrayed} — and no one leaves unscathed.",
        "twists": ("the {lover} was secretly recording every word", "a paternity letter was already in the mail", "the betrayed {betrayed} had known for months and said nothing", "the affair had been arranged by the family matriarch herself"),
        "beats": (
            ("Last time, {betrayed} still believed the marriage was untouchable.", ("betrayed",), "s", "Looking calmly out a rain-blurred window."),
            ("But {cheater} kept slipping away at midnight, again and again.", ("cheater",), "*", "Glancing over one shoulder, phone hidden."),
            ("A whispered call. A deleted message. The truth clawed toward the surface.", ("cheater", "lover"), "*", "Leaning close, whispering."),
            ("Then the door opened — and {betrayed} saw everything.", ("betrayed", "cheater", "lover"), "s", "Frozen in the doorway, betrayal on every face."),
            ("'How long?' {betrayed} whispered. The silence answered for them.", ("betrayed", "cheater"), "s", "Tears and trembling hands, faces inches apart."),
            ("But no one noticed {twist} — and everything is about to shatter.", ("lover",), "s", "A slow, knowing half-smile in the shadows."),
        ),
    },
    "pregnancy": {
        "slots": {"mother": ("temptress", "innocent"), "father": ("villain", "heir"), "matri": ("matriarch",), "other": ("heir",)},
        "title": "The Test in the Drawer",
        "logline": "{mother^} hides a pregnancy that could topple the family — but the secret refuses to stay buried.",
        "twists": ("the real father was {other}", "there were two heartbeats, not one", "the matriarch had swapped the test results", "the pregnancy would decide who inherits everything"),
        "beats": (
            ("Last time, {mother} swore the family name would stay spotless.", ("mother",), "s", "Standing very still, one hand on her stomach."),
            ("But {mother} hid a pregnancy test deep in the drawer.", ("mother",), 1, "Holding a pregnancy test with tears in her eyes."),
            ("{matri^} sensed a secret and started asking questions.", ("matri", "mother"), "s", "An accusing stare meeting a guilty one."),
            ("'You're pregnant.' The words dropped like glass in front of everyone.", ("mother", "father", "matri"), "s", "A whole room turning to stare."),
            ("{father^} went pale — because he knew it couldn't be his.", ("father",), "s", "Draining of color, gripping the back of a chair."),
            ("What no one knew: {twist}.", ("mother",), "s", "A single hand resting on her stomach, a faint secret smile."),
        ),
    },
    "dynasty": {
        "slots": {"matri": ("matriarch",), "heir1": ("heir",), "heir2": ("villain",), "other": ("villain",)},
        "title": "Blood and Vineyards",
        "logline": "When {matri} announces the heir to the family empire, {heir1} and {heir2} go to war.",
        "twists": ("the will had been rewritten one hour before the reading", "the estate was already secretly sold to {other}", "there was a third heir no one had ever met", "the matriarch was still very much alive"),
        "beats": (
            ("Last time, {matri} promised the empire to only one child.", ("matri",), "s", "Seated at the head of a long table, unreadable."),
            ("{heir1^} and {heir2} circled the inheritance like wolves.", ("heir1", "heir2"), "s", "Two rivals sizing each other up across the room."),
            ("A forged signature. A missing ledger. The empire began to crack.", ("heir2",), 6, "Sliding a document into a briefcase, alone."),
            ("At the will's reading, {matri} named the heir — and the room erupted.", ("matri", "heir1", "heir2"), "s", "A dropped envelope, shouting, chaos."),
            ("'You were never family,' {heir2} hissed at {heir1}.", ("heir1", "heir2"), "s", "Faces inches apart, pure venom."),
            ("But hidden in the fine print: {twist}.", ("matri",), "s", "A close-up on a signature and a knowing eye."),
        ),
    },
    "revenge": {
        "slots": {"wronged": ("innocent", "heir"), "target": ("villain", "temptress"), "other": ("villain",)},
        "title": "A Cold Dish",
        "logline": "After years of humiliation, {wronged} finally moves against {target} — but revenge has a price.",
        "twists": ("the revenge had ruined the wrong person entirely", "the target had already planned a counter-move with {other}", "the wronged one had a partner nobody suspected", "the whole scheme was being watched from the start"),
        "beats": (
            ("Last time, {wronged} vowed that one day the debt would be paid.", ("wronged",), "s", "Staring at an old photograph, jaw tight."),
            ("Quietly, {wronged} gathered every secret {target} had buried.", ("wronged",), 6, "Spreading documents across a desk at night."),
            ("One phone call would end an empire. A finger hovered over 'send'.", ("wronged",), "s", "A trembling hand over a glowing phone screen."),
            ("At the gala, the truth about {target} played on every screen.", ("target",), 5, "Horror spreading across a face under bright lights."),
            ("'You did this,' {target} breathed. {wronged} only smiled.", ("wronged", "target"), "s", "One calm face, one crumbling face."),
            ("What the crowd never saw: {twist}.", ("target",), "s", "A slow turn toward the camera, eyes hardening."),
        ),
    },
    "secret_identity": {
        "slots": {"stranger": ("temptress", "heir"), "family": ("matriarch",), "foil": ("villain",)},
        "title": "The Stranger at the Gate",
        "logline": "A charming newcomer, {stranger}, arrives at the estate — and nothing about their story adds up.",
        "twists": ("the stranger was the long-lost child of {family}", "the new arrival had come to take back everything", "the foil had known the true identity all along", "the family had faked a death years ago to hide it"),
        "beats": (
            ("Last time, {family} welcomed a stranger into the family home.", ("family", "stranger"), "s", "A polite handshake with wary eyes."),
            ("But {stranger} knew things no outsider ever should.", ("stranger",), "s", "Tracing a finger over an old family portrait."),
            ("{foil^} started digging into the newcomer's past.", ("foil",), 6, "Studying a file under a single desk lamp."),
            ("'I know who you really are,' {foil} said. The room went silent.", ("foil", "stranger", "family"), "s", "Every head turning at once."),
            ("{stranger^} pulled out a photograph — and {family} gasped.", ("family",), "s", "A hand flying to the mouth, eyes wide."),
            ("The secret they'd all been hiding: {twist}.", ("stranger",), "s", "A slow, unreadable smile in the doorway."),
        ),
    },
}
