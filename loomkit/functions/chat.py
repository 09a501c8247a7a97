"""Chat-style training text (P3, P4, P5) and completion repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomkit.functions.markup import let
from loomkit.functions.text import py_lstrip, py_strip

# Chat markers, the user instruction and the generation primer.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
INSTRUCTION = "Generate an SVG for: "
PRIMER = '<?xml version="1" encoding="UTF-8"?><!-- Generator: visioncortex VTracer 0.6.12 -->\n<svg'
FENCES = ("```xml", "```svg", "```")


def chat_text(caption: Column, svg: Column) -> Column:
    """One user turn asking for the caption, one assistant turn with the markup."""
    return F.concat(F.lit(f"{IM_START}user\n{INSTRUCTION}"), caption, F.lit(f"{IM_END}\n{IM_START}assistant\n"),
                    svg, F.lit(IM_END))


def prompt_text(caption: Column, primer: bool = False) -> Column:
    """The prompt only, optionally primed with the generator header and ``<svg``."""
    head = F.concat(F.lit(f"{IM_START}user\n{INSTRUCTION}"), caption, F.lit(f"{IM_END}\n{IM_START}assistant\n"))
    return F.concat(head, F.lit(PRIMER)) if primer else head


def turn_text(role: Column, text: Column) -> Column:
    """P5 building block: ``<|im_start|>{role}\\n{text}<|im_end|>``."""
    return F.concat(F.lit(IM_START), role, F.lit("\n"), text, F.lit(IM_END))


def extract_svg(response: Column, mode: str = "faithful") -> Column:
    """Repair a model response into one ``<svg ...>...</svg>`` document.

    Faithful: fences removed, stripped, ``<svg `` prepended when missing (text before
    a later ``<svg`` stays), cut after the first ``</svg>`` or ``\\n</svg>`` appended.
    Safe: cut at the first ``<svg`` before prepending.
    """
    if mode not in ("faithful", "safe"):
        raise ValueError(f"unknown mode {mode!r}")
    s = response
    for fence in FENCES:
        s = F.replace(s, F.lit(fence), F.lit(""))

    def prefixed(t: Column) -> Column:
        if mode == "faithful":
            return F.when(t.startswith("<svg"), t).otherwise(F.concat(F.lit("<svg "), py_lstrip(t)))
        at = F.locate("<svg", t)
        return F.when(at > 0, t.substr(at, F.length(t) + 1)).otherwise(F.concat(F.lit("<svg "), py_lstrip(t)))

    def closed(t: Column) -> Column:
        end = F.locate("</svg>", t)
        return F.when(end > 0, F.substring(t, F.lit(1), end + 5)).otherwise(F.concat(t, F.lit("\n</svg>")))
    # each stage is bound once (let), so the strip regex runs once per response
    return let(let(py_strip(s), prefixed), closed)


def file_name(prompt: Column) -> Column:
    """Blanks -> ``_``, plus ``.svg``."""
    return F.concat(F.replace(prompt, F.lit(" "), F.lit("_")), F.lit(".svg"))


def preview_name(output_path: Column) -> Column:
    """``<base>_preview.png`` where base drops the last extension of the file name."""
    base = F.regexp_replace(output_path, r"(?<=[^/])\.[^./]*$", "")
    return F.concat(base, F.lit("_preview.png"))
