"""Prompt and template construction (group D).

Everything is a column expression (concat, when, array transforms), so it stays inside
whole-stage codegen and the scan still prunes columns.  Conversation-level templates
work on one sorted ``array<struct<turn, role, text>>`` per thread, built by a
group-by on the thread id: a thread is small, the corpus is spread by thread.
Newlines in templates are part of the contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import SPACE_CLASS, col_

# fixed values: instruction wrappers and chat markers of the reference templates
SUMMARIZE_PREFIX = "Summarize the following conversation.\n\n"
SUMMARIZE_SUFFIX = "\n\nSummary: "
BEGIN_INST, END_INST = "[INST] ", " [/INST] "
BEGIN_SYS, END_SYS = "<<SYS>>\n", "\n<</SYS>>\n\n"
BOS, EOS = "<s>", "</s>"
INST_HEADER = "\n\n[INST] Given a question and some additional context, provide an answer. [/INST]\n\n"
GUARD_CATEGORIES = ["O1: Violence and Hate.", "O2: Sexual Content.", "O3: Criminal Planning.",
                    "O4: Guns and Illegal Weapons.", "O5: Regulated or Controlled Substances.", "O6: Self-Harm."]


def strip(c: Column | str) -> Column:
    """Python ``str.strip()`` on ASCII whitespace."""
    return F.regexp_replace(col_(c), f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def rstrip(c: Column | str) -> Column:
    return F.regexp_replace(col_(c), f"[{SPACE_CLASS}]+$", "")


def wrap(c: Column | str, prefix: str = SUMMARIZE_PREFIX, suffix: str = SUMMARIZE_SUFFIX) -> Column:
    return F.concat(F.lit(prefix), col_(c), F.lit(suffix))


def dolly_prompt(instruction: Column, context: Column, response: Column, eos: str = EOS) -> Column:
    """``### Instruction`` / optional ``### Context`` / ``### Answer`` joined by a blank line, then EOS."""
    ctx = F.when(F.coalesce(F.length(context), F.lit(0)) > 0, F.concat(F.lit("### Context\n"), context))
    return F.concat(F.concat_ws("\n\n", F.concat(F.lit("### Instruction\n"), instruction), ctx,
                                F.concat(F.lit("### Answer\n"), response)), F.lit(eos))


def inst_context_prompt(instruction: Column, context: Column, response: Column) -> Column:
    ctx = F.when(F.coalesce(F.length(context), F.lit(0)) > 0, F.concat(F.lit("Here is some context: "), context)).otherwise(F.lit(""))
    return F.concat(F.lit(INST_HEADER + "### Question:\n"), instruction, F.lit("\n\n### Context:\n"), ctx,
                    F.lit("\n\n### Response:\n"), response, F.lit("\n\n</s>\n"))


def qa_prompt(question: Column, answer: Column | None = None) -> Column:
    q = F.concat(F.lit("Question: "), question, F.lit("\n\nAnswer: "))
    return q if answer is None else F.concat(q, answer)


def label_prompt(text: Column, column_name: str) -> Column:
    return F.concat(F.lit(f"{column_name} : "), text, F.lit(" Label : "))


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` placeholders from columns."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v, F.lit("")))
    return out


def threads(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per thread with ``msgs``: turns sorted by ``turn``."""
    return (conversations.groupBy(conv)
            .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("msgs")))


def _role_text(arr: Column, role: str) -> Column:
    return F.transform(F.filter(arr, lambda m: m["role"] == role), lambda m: m["text"])


def fold_system(msgs: Column) -> Column:
    """A leading system turn is folded into the next turn inside ``<<SYS>>`` markers."""
    first_sys = (F.size(msgs) >= 2) & (msgs[0]["role"] == "system")
    folded = F.concat(
        F.array(F.struct(msgs[1]["turn"].alias("turn"), msgs[1]["role"].alias("role"),
                         F.concat(F.lit(BEGIN_SYS), msgs[0]["text"], F.lit(END_SYS), msgs[1]["text"]).alias("text"))),
        F.slice(msgs, 3, F.greatest(F.size(msgs) - 2, F.lit(0))))
    return F.when(first_sys, folded).otherwise(msgs)


def turn_order_error(msgs: Column) -> Column:
    """Error text for a thread that does not alternate user/assistant after an optional system turn, or does not end on user."""
    m = fold_system(msgs)
    bad_order = F.exists(F.transform(m, lambda x, i: F.struct(x["role"].alias("r"), i.alias("i"))),
                         lambda s: F.when(s["i"] % 2 == 0, s["r"] != "user").otherwise(s["r"] != "assistant"))
    last = F.try_element_at(m, F.lit(-1))["role"]
    return (F.when(F.size(m) == 0, F.lit("empty conversation"))
            .when(bad_order, F.lit("roles must alternate user/assistant after an optional system turn"))
            .when(last != "user", F.concat(F.lit("last message must be from user, got "), last)))


def render_llama_chat(msgs: Column, bos: str = BOS, eos: str = EOS) -> Column:
    """``bos [INST] user [/INST] assistant eos`` per exchange, then the open user turn; null when invalid."""
    m = fold_system(msgs)
    pairs = (F.size(m) - 1) / 2
    body = F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.size(m) - 2, F.lit(0)), F.lit(2)),
                                             lambda i: i + 1 < F.size(m)),
                                    lambda i: F.concat(F.lit(bos + BEGIN_INST), strip(m[i]["text"]), F.lit(END_INST),
                                                       strip(m[i + 1]["text"]), F.lit(eos))), "")
    out = F.concat(body, F.lit(bos + BEGIN_INST), strip(F.try_element_at(m, F.lit(-1))["text"]), F.lit(END_INST))
    return F.when(turn_order_error(msgs).isNull() & (pairs >= 0), out)


def chat_history(msgs: Column) -> Column:
    """First query, then ``\\n response \\n </s><s>[INST] \\n query \\n [/INST]`` per exchange."""
    q = _role_text(msgs, "user")
    r = _role_text(msgs, "assistant")
    n = F.least(F.size(r), F.size(q) - 1)
    steps = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i < n),
                        lambda i: F.concat(F.lit("\n"), r[i], F.lit("\n </s><s>[INST] \n"), q[i + 1], F.lit("\n [/INST]")))
    return F.when(F.size(q) > 0, F.concat(F.lit("<s>[INST] "), q[0], F.lit(" [/INST]"), F.array_join(steps, "")))


def render_messages(messages: Column, template: Mapping[str, tuple[str, str]]) -> Column:
    """Render ``array<struct<role, content>>`` with a (prefix, suffix) per role."""
    def one(m):
        pre = F.lit("")
        suf = F.lit("")
        for role, (p, s) in template.items():
            pre = F.when(m["role"] == role, F.lit(p)).otherwise(pre)
            suf = F.when(m["role"] == role, F.lit(s)).otherwise(suf)
        return F.concat(pre, m["content"], suf)
    return F.array_join(F.transform(messages, one), "")


def guard_prompt(conversation: Column, role: str = "User", categories: Sequence[str] = GUARD_CATEGORIES, policy: str | None = None) -> Column:
    """Safety prompt; ``policy`` replaces the block of category names by the caller's own text."""
    task = (f"Task: Check if there is unsafe content in '{role}' messages in conversations "
            "according our safety policy with the below categories.")
    policy = "<BEGIN UNSAFE CONTENT CATEGORIES>\n" + (policy or "\n".join(categories)) + "\n<END UNSAFE CONTENT CATEGORIES>"
    fmt = (f"Provide your safety assessment for '{role}' in the above conversation:\n"
           "- First line must read 'safe' or 'unsafe'.\n"
           "- If unsafe, a second line must include a comma-separated list of violated categories.")
    return F.concat(F.lit(f"\n{task}\n\n{policy}\n\n\n<BEGIN CONVERSATION>\n{role}: "), conversation,
                    F.lit(f"\n<END CONVERSATION>\n\n\n{fmt}\n\n"))


def web_prompt(msgs: Column, query: Column, context: Column, run_date: str) -> Column:
    """Content that replaces the last message when a web search ran."""
    users = _role_text(msgs, "user")
    prev = F.slice(users, 1, F.greatest(F.size(users) - 1, F.lit(0)))
    last_q = F.coalesce(F.try_element_at(users, F.lit(-1)), F.lit(""))
    prev_txt = F.when(F.size(prev) > 0, F.concat(F.lit("Previous questions: \n- "), F.array_join(prev, "\n- "))).otherwise(F.lit(""))
    return F.concat(F.lit("I searched the web using the query: "), query, F.lit(f". \nToday is {run_date} and here are the results:\n"
                    "=====================\n"), context, F.lit("\n=====================\n"), prev_txt,
                    F.lit("\nAnswer the question: "), last_q)


def search_query_prompt(msgs: Column) -> Column:
    users = _role_text(msgs, "user")
    prev = F.slice(users, 1, F.greatest(F.size(users) - 1, F.lit(0)))
    prev_txt = F.when(F.size(prev) > 0, F.concat(F.lit("Previous questions: \n"),
                                                 F.array_join(F.transform(prev, lambda x: F.concat(F.lit("- "), x)), "\n"))).otherwise(F.lit(""))
    return F.concat(prev_txt, F.lit("\n\nCurrent Question: "), F.try_element_at(users, F.lit(-1)))


def query_modifier(allow: Sequence[str], block: Sequence[str]) -> str:
    return " ".join([f"site:{a}" for a in allow] + [f"-site:{b}" for b in block])


def keep_last_words(c: Column | str, n: int) -> Column:
    """Last n space-separated words; n = 0 keeps everything (``slice(-0)``)."""
    if n == 0:
        return col_(c)
    parts = F.split(col_(c), " ", -1)
    start = F.greatest(F.size(parts) - n, F.lit(0)) + 1
    return F.array_join(F.slice(parts, start, F.lit(n)), " ")


def strip_stops(c: Column | str, stops: Sequence[str]) -> Column:
    """Right-trim, then remove each stop string in turn when the text ends with it."""
    out = rstrip(c)
    for s in stops:
        out = F.when(out.endswith(s), out.substr(F.lit(1), F.length(out) - F.lit(len(s)))).otherwise(out)
    return out


def pick_template(templates: Sequence[str], key: Column) -> Column:
    """Template chosen by a seeded hash bucket of ``key`` (deterministic 'random choice')."""
    from corpusflow.functions.text import seeded_int

    arr = F.array(*[F.lit(tpl) for tpl in templates])
    return F.element_at(arr, (F.pmod(seeded_int(13, key), F.lit(len(templates))) + 1).cast("int"))


def article(word: Column) -> Column:
    """'an' before a vowel letter, else 'a'."""
    return F.when(F.lower(F.substring(word, 1, 1)).isin("a", "e", "i", "o", "u"), F.lit("an")).otherwise(F.lit("a"))
