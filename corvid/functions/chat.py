"""Chat template rendering and reply decoding as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvid.functions.text import py_strip, tokenize_words

# The tag-marked chat template.
BOS = "<|begin_of_text|>"
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>"
EOT = "<|eot_id|>"
SPECIAL_TOKENS = [BOS, HEADER_START, HEADER_END, EOT]
# The tokenizer has no pad token, so padding uses the end token.
PAD_TOKEN = None
EOS_TOKEN = EOT
QUIT_WORD = "quit"


@dataclass(frozen=True)
class Template:
    """The tags a conversation is rendered with."""
    bos: str = BOS
    header_start: str = HEADER_START
    header_end: str = HEADER_END
    header_tail: str = "\n"
    end: str = EOT

    def header(self, role: Column) -> Column:
        return F.concat(F.lit(self.header_start), role, F.lit(self.header_end), F.lit(self.header_tail))


TEMPLATE = Template()


def render_segment(role: Column, text: Column, template: Template = TEMPLATE) -> Column:
    """One message: header, content, end-of-turn tag."""
    return F.concat(template.header(role), text, F.lit(template.end))


def generation_prompt(template: Template = TEMPLATE) -> Column:
    """The open assistant header appended when asking for a reply."""
    return template.header(F.lit("assistant"))


def segment_tokens(role: Column, text: Column) -> Column:
    """Token form of one message: 3 header tokens, the words, the end tag."""
    return F.concat(F.array(F.lit(HEADER_START), role, F.lit(HEADER_END)),
                    tokenize_words(text), F.array(F.lit(EOT)))


def decode_reply(tokens: Column, prompt_len: Column) -> Column:
    """X11: drop the prompt part, drop special tokens, join, strip."""
    reply = F.slice(tokens, prompt_len + F.lit(1), F.greatest(F.size(tokens) - prompt_len, F.lit(0)))
    specials = F.array(*[F.lit(t) for t in SPECIAL_TOKENS])
    kept = F.filter(reply, lambda t: ~F.array_contains(specials, t))
    return py_strip(F.array_join(kept, " "))


def is_quit(text: Column) -> Column:
    return F.lower(py_strip(text)) == F.lit(QUIT_WORD)
