"""Rows with everything that documents may hold: nulls, empty and long texts, ties, repeated rows."""

LONG = " ".join(f"w{i % 977}{i % 31}" for i in range(40_000))
ROWS = [
    (10, "The quick brown fox jumps over the lazy dog again and again"),
    (3, "the QUICK brown fox jumps over the lazy dog again and again"),
    (7, "The quick brown fox jumps over the lazy dog again and again"),
    (7, "The quick brown fox jumps over the lazy dog again and again"),
    (1, None),
    (2, ""),
    (None, "without any id but with words enough to count"),
    (4, " \t\n\x0b "),
    (5, LONG),
    (6, LONG + " tail"),
    (8, "Ünï É é ß 日本 <|endoftext|> é   x y"),
    (13, "a <|endoftext|> b<|startoftext|>c <|EndOfText|> <|"),
    (9, "one two three"),
    (11, "one TWO three"),
    (12, "mail a.b@c.de or +1 (415) 555-0100, 4111 1111 1111 1111 at 10.0.0.255 and 1.2.3.999"),
]
