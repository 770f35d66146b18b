"""The record: its parts, fields and permitted values, as one table.

Everything else about the record (Spark types, JSON Schema text, checking rules,
leaf columns) is derived from this table.
"""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    """One field of a part.

    ``kind`` is ``text``, ``flag``, ``whole`` (integer), ``texts`` (list of text),
    ``part`` (nested object) or ``parts`` (list of objects); the last two name the
    nested part in ``part``.  ``optional`` fields may be missing or null.
    """

    name: str
    kind: str = "text"
    about: str | None = None
    examples: tuple[str, ...] = ()
    choices: tuple[str, ...] = ()
    part: str | None = None
    optional: bool = False


# Part names, field names, descriptions, examples and permitted
# values. An exported schema must carry these texts unchanged.

DIFFICULTIES = ("Beginner", "Intermediate")

SIMULATED_SOURCES = (
    "Ask Ubuntu Forum",
    "Arch Wiki Discussion",
    "Reddit r/linuxquestions",
    "Stack Overflow",
)

NEXT_STEP_TYPES = (
    "RunAnotherDiagnosticCommand",
    "ReadyForSolution",
    "OutputNeedsUserClarification",
)

ROOT = "LinuxAdminDataEntry"

PARTS: dict[str, tuple[Field, ...]] = {
    "ProblemMetadata": (
        Field("category", "text", "The broad technical area of the problem.",
              ("Package Management", "Networking", "Hardware (Drivers/Peripherals)")),
        Field("subcategory", "text", "A more specific description within the category.",
              ("Dependency Conflict", "Wi-Fi Connectivity", "USB Device Not Recognized")),
        Field("difficulty", "text", "Estimation of the technical difficulty level.",
              choices=DIFFICULTIES),
        Field("simulated_source", "text",
              "The type of platform or source this interaction mimics.",
              choices=SIMULATED_SOURCES),
        Field("requires_diagnostic", "flag",
              "True if this problem commonly requires diagnostic commands."),
        Field("tested_in_vm_recommended", "flag",
              "True if the solution carries significant risk and VM testing is advised."),
    ),
    "SystemContext": (
        Field("distribution", "text", None,
              ("Ubuntu 22.04 LTS", "Fedora 39", "openSUSE Leap 15.0")),
        Field("kernel_version", "text", "Output of uname -r.", ("5.15.0-86-generic",)),
    ),
    "UserProblemPost": (
        Field("title", "text", "A concise, attention-grabbing summary of the problem."),
        Field("persona_description", "text",
              "User's background, experience level, and comfort with CLI/GUI.",
              ("Intermediate Ubuntu user comfortable with terminal basics but unfamiliar "
               "with kernel modules",)),
        Field("problem_description", "text", "User's narrative explaining the issue."),
        Field("system_context", "part", part="SystemContext"),
        Field("user_goal", "text", "Clear statement of what the user wants to achieve."),
    ),
    "DiagnosticStep": (
        Field("reason_for_command", "text", "Why this diagnostic command is being run."),
        Field("diagnostic_command", "text", "The exact non-modifying command.",
              ("dmesg | grep -i usb", "lsusb")),
        Field("simulated_output", "text",
              "Simulated output of the command, using code block formatting."),
        Field("interpretation", "text", "Expert's interpretation of the simulated_output."),
        Field("informs_next_step_type", "text",
              "What the interpretation suggests for the next step.",
              choices=NEXT_STEP_TYPES),
    ),
    "RelevantExpertContext": (
        Field("experience_snippet", "text", None,
              ("Having resolved numerous USB device conflicts on Ubuntu systems...",)),
        Field("effective_strategy_overview", "text",
              "General approach or reasoning behind the solution."),
    ),
    "StepByStepFixItem": (
        Field("step_number", "whole"),
        Field("instruction", "text", "User-friendly explanation of what to do."),
        Field("commands", "texts", "Exact command(s) to run, if applicable.", optional=True),
        Field("gui_path", "text", "Path through GUI, if applicable.", optional=True),
        Field("explanation", "text", "What the command or GUI action does."),
        Field("warning", "text", "Step-specific caution if potentially risky.", optional=True),
    ),
    "VerificationStep": (
        Field("instruction", "text"),
        Field("expected_output", "text", "What output should look like if successful.",
              optional=True),
    ),
    "AlternativeSolution": (
        Field("description", "text"),
        Field("commands", "texts", optional=True),
        Field("warnings", "texts", optional=True),
    ),
    "ExpertSolutionReply": (
        Field("acknowledgement", "text"),
        Field("explanation", "text",
              "Summary explanation of why the overall solution works and the likely root cause."),
        Field("root_cause_simplified", "text"),
    ),
    ROOT: (
        Field("problem_metadata", "part", part="ProblemMetadata"),
        Field("user_problem_post", "part", part="UserProblemPost"),
        Field("expert_solution_reply", "part", part="ExpertSolutionReply"),
    ),
}

# Fields that are declared but not part of the active record, with the part that
# would hold them.
INACTIVE_FIELDS: dict[str, tuple[Field, ...]] = {
    ROOT: (Field("diagnostic_reasoning_process", "parts", part="DiagnosticStep"),),
    "ExpertSolutionReply": (
        Field("relevant_expert_context", "part", part="RelevantExpertContext"),
        Field("step_by_step_fix", "parts", part="StepByStepFixItem"),
        Field("verification_steps", "parts", part="VerificationStep"),
        Field("alternative_solutions", "parts", part="AlternativeSolution", optional=True),
    ),
}

# End of fixed values.


def fields_of(part: str, extended: bool = False) -> tuple[Field, ...]:
    """Fields of a part; ``extended`` adds the inactive ones."""
    return PARTS[part] + (INACTIVE_FIELDS.get(part, ()) if extended else ())
