import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"


def sentence(seed: int, n: int) -> str:
    """n words that other seeds do not share."""
    return " ".join(f"w{seed}x{(i * 7 + seed * 13) % 9973}" for i in range(n))


def corpus() -> list[tuple]:
    """Nulls, empty, tiny and very long texts, copies, near copies, shared passages, repeated rows, odd columns."""
    shared, long = sentence(900, 60), sentence(901, 9000)
    base = sentence(1, 120)
    texts = {
        0: base, 1: base, 2: base + " tail", 3: None, 4: "", 5: " \n\t ", 6: "one two", 7: "Five Words Are In Here",
        8: "five words are in here", 9: long, 10: long + " end", 11: sentence(2, 40) + " " + shared + " " + sentence(3, 40),
        12: sentence(4, 30) + "\n" + shared + "\n" + sentence(5, 35), 13: "a " * 130, 14: "né'e 漢字。 don't <|endoftext|> 😀\x1c" * 9,
        15: sentence(6, 25) + " ### $$$ %%% *** &&& ||| <<< >>> ###" * 6, 16: "x" * 5000, 17: "\n".join(["same line here"] * 30),
    }
    rows = [(d, t, "en" if d % 2 else None, None if d % 5 == 0 else f"s{d % 3}", 1, "clash", "k") for d, t in texts.items()]
    return [*rows, rows[0], (None, sentence(7, 80), "de", "s1", None, None, None)]
