"""Texts that operators on texts have to stand."""

ODD = [
    None, "", " ", "\n\n \t", "a", "  two  spaces ", "tabs\tand\nlines\r\n\r\nend ", "don't we'll I'm 's 'tis it's'd", "aaaa aaaaaaaaaaa aaa",
    "İstanbul ΣΑΣ ςσΣ", "é ́ é ﬁ", "日本語テキスト 한국어 العربية", "😀👩‍👩‍👧 x", "a b c\u0085d\x1ce\x1f f᠎g", "1234567 12.5e7 ½ ²",
    "<|endoftext|>", "a<|endoftext|> b <|startoftext|><|endoftext|>", "<|endoftext", "<|ENDOFTEXT|>", "\x00\x01�​",
    "x" * 3000, "word " * 2000, "ab" * 4000 + " " + "é" * 999, "가 Ω K Å", "a\n b\n  c \n", "!!!???... --- ***",
]
