"""Word lists and pairs that must agree with the data's own conventions."""

#: Words that mark a text as English.
STRONG_ENGLISH = (
    "the of and or to from with without for is are was were be been being you your yours you're you've you'll we our ours "
    "they their theirs they're them he his him she her hers this that these those not can could will would should do does did "
    "have has had in on at by as but if when where what why how who which whose through into about before after first then now "
    "also just really something anything everything nothing there here only don't doesn't didn't isn't aren't wasn't weren't won't "
    "wouldn't shouldn't can't cannot haven't hasn't let's keep reading bored daughter son mother father witch workshop broomstick "
    "museum recipe candy book train ticket village house white prickly vine"
).split()
#: Of these, words that may not be Portuguese as well.
PARTIAL_ENGLISH = (
    "the and or to from with without is are was were been being you your yours you're you've you'll we our ours they their theirs "
    "they're them his him she her hers this that these those not can could would should does did have has had but if when where what "
    "why how who which whose through into about before after first then now also just really something anything everything nothing "
    "there here only don't doesn't didn't isn't aren't wasn't weren't won't wouldn't shouldn't can't cannot haven't hasn't daughter son "
    "mother father witch workshop broomstick museum recipe candy book train ticket village house"
).split()
#: Portuguese forms that show the speaker's gender, masculine and feminine.
GENDER_PAIRS = (
    ("obrigado", "obrigada"),
    ("animado", "animada"),
    ("cansado", "cansada"),
    ("preocupado", "preocupada"),
    ("surpreso", "surpresa"),
    ("curioso", "curiosa"),
    ("ansioso", "ansiosa"),
    ("aliviado", "aliviada"),
    ("ocupado", "ocupada"),
    ("confuso", "confusa"),
    ("impressionado", "impressionada"),
    ("interessado", "interessada"),
    ("empolgado", "empolgada"),
    ("chocado", "chocada"),
    ("nervoso", "nervosa"),
    ("sozinho", "sozinha"),
    ("grato", "grata"),
    ("certo", "certa"),
    ("convencido", "convencida"),
    ("perdido", "perdida"),
    ("pronto", "pronta"),
    ("decepcionado", "decepcionada"),
    ("entediado", "entediada"),
    ("assustado", "assustada"),
    ("envergonhado", "envergonhada"),
    ("acostumado", "acostumada"),
)
#: Forms whose change of gender a guard rejects.
GUARDED_GENDER = (
    ("obrigado", "obrigada"),
    ("direto", "direta"),
    ("pronto", "pronta"),
    ("sozinho", "sozinha"),
    ("cansado", "cansada"),
    ("perdido", "perdida"),
    ("animado", "animada"),
    ("ocupado", "ocupada"),
    ("preocupado", "preocupada"),
    ("felizardo", "felizarda"),
    ("confuso", "confusa"),
    ("assustado", "assustada"),
    ("desculpado", "desculpada"),
    ("digno", "digna"),
)
#: Texts that stand for themselves.
PASS_THROUGH = ("???", "...", "-", "_")
