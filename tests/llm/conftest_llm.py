"""Rows shared by the tests of the operators."""
#: Texts that every operator must survive.
ODD = [None, "", " ", "\n\n", "a", "a a a", "Ünï cödé 漢字 \U0001f600 end", "x" * 5000, "tab\tnew\r\nline  two   three \n b",
       "the same line\nthe same line\nthe same line", "<|endoftext|> is text", "nul\x00byte", "é" * 300,
       "word " * 4000]
