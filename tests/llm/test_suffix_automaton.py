from hypothesis import given, settings, strategies as st

from rollbook.llm.suffix_automaton import SuffixAutomaton

TEXT = st.text("abc", max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6, unique=True), TEXT)
def test_matching_statistics_and_endings(patterns, text):
    automaton = SuffixAutomaton((p, p) for p in patterns)
    state = matched = 0
    node = automaton.walk_start
    for end, letter in enumerate(text, 1):
        state, matched = automaton.step(state, matched, letter)
        suffixes = [text[start:end] for start in range(end + 1)]
        assert matched == next(len(s) for s in suffixes if any(s in p for p in patterns))
        expected = [(len(s), s) for s in suffixes if s and s in patterns]
        assert list(automaton.ending(state, matched)) == expected
        node = node[0].get(letter) or automaton.walk_step(node, letter)
        assert list(node[1]) == expected
