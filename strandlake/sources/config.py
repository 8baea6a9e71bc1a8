"""Settings files: `key: value` lines with # comments and templates that are inherited."""

from __future__ import annotations

from pathlib import Path


def parse(text: str) -> dict[str, str]:
    """Settings in order; blank lines and comments are skipped, a line without a colon is an error."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        line = line.split("#", 1)[0].strip()
        if line:
            key, colon, value = line.partition(":")
            if not colon:
                raise ValueError(f"no colon in {line!r}")
            out[key.strip()] = value.strip()
    return out


def load(path: str, folders: list[str] | None = None) -> dict[str, str]:
    """The settings of a file over those of the template it names, and so on up."""
    own = parse(Path(path).read_text())
    name = own.get("template_config")
    if not name:
        return own
    for folder in [str(Path(path).parent), *(folders or [])]:
        if (found := Path(folder) / name).exists():
            return load(str(found), folders) | own
    raise FileNotFoundError(name)


def dump(settings: dict[str, str]) -> str:
    return "".join(f"{k}: {v}\n" for k, v in settings.items())


def boolean(settings: dict[str, str], key: str) -> bool:
    value = settings[key].upper()
    if value not in ("TRUE", "FALSE"):
        raise ValueError(f"{key} is not a boolean")
    return value == "TRUE"


def number(settings: dict[str, str], key: str, low: float | None = None, high: float | None = None) -> float:
    value = float(settings[key])
    if (low is not None and value < low) or (high is not None and value > high):
        raise ValueError(f"{key} is out of range")
    return value


def listed(settings: dict[str, str], key: str) -> list[str]:
    return [x for x in settings.get(key, "").replace(" ", "").split(",") if x]


def unknown(settings: dict[str, str], known: dict[str, str]) -> list[str]:
    return sorted(set(settings) - set(known))


#: Settings with a range of numbers (empty ones are let pass), those that choose among words, and those that are true or false.
RANGES = {"num_cores": (1, None), "chunk_size": (1, None), "subsample_nbreads": (0, None), "max_nbchunks": (1, None), "trimReads.length": (1, None), "trimReads.trim5": (0, None), "filterQuality.minQuality": (0, 40), "filterQuality.minFrac": (0, 1), "filterQuality.minLength": (0, None), "shortReadReport.subsample_nbreads": (0, None), "alignReads.max_mismatches": (0, None), "coverage.maxFragmentLength": (0, None), "analyzeVariants.bqual": (0, 41)}
CHOICES = {"overwrite_save_dir": ("never", "erase", "overwrite"), "debug.level": ("ERROR", "WARN", "INFO", "DEBUG"), "alignReads.analyzedBam": ("uniq", "concordant_uniq"), "quality_encoding": ("sanger", "solexa", "illumina1.3", "illumina1.5", "illumina1.8", "GATK-rescaled")}
SWITCHES = ("paired_ends", "trimReads.do", "filterQuality.do", "detectAdapterContam.do", "detectAdapterContam.force_paired_end_adapter", "detectRRNA.do", "shortReadReport.do", "markDuplicates.do", "countGenomicFeatures.do", "coverage.do", "coverage.extendReads", "analyzeVariants.do", "analyzeVariants.indels", "analyzeVariants.genotype")
WITHOUT_BLANKS = ("input_file", "input_file2", "save_dir", "prepend_str", "alignReads.sam_id")


def faults(settings: dict[str, str], calling_filters: tuple[str, ...] = (), post_filters: tuple[str, ...] = ()) -> list[str]:
    """What is wrong with the settings, in words; none for good ones. Only settings that are there are looked at."""
    has = {k: v for k, v in settings.items() if v != ""}
    out = []

    def say(wrong: bool, text: str) -> None:
        if wrong:
            out.append(text)

    for key, (low, high) in RANGES.items():
        if key in has:
            try:
                number(has, key, low, high)
            except ValueError:
                out.append(f"{key} must be a number from {low}" + (f" to {high}" if high is not None else ""))
    for key, words in CHOICES.items():
        say(key in has and has[key] not in words, f"{key} must be one of {', '.join(words)}")
    for key in SWITCHES:
        say(key in has and has[key].upper() not in ("TRUE", "FALSE"), f"{key} must be TRUE or FALSE")
    for key in WITHOUT_BLANKS:
        say(" " in has.get(key, ""), f"{key} holds a blank")
    on = lambda key: has.get(key, "").upper() == "TRUE"
    if "paired_ends" in has:
        say(on("paired_ends") and "input_file2" not in has, "paired reads need input_file2")
        say(not on("paired_ends") and "input_file2" in has, "input_file2 is for paired reads")
    say("input_file" in has and has["input_file"] == has.get("input_file2"), "the input files are the same")
    trims = "trimReads.length" in has or has.get("trimReads.trim5", "0") not in ("0", "")
    say("trimReads.do" in has and on("trimReads.do") != trims, "trimReads.do and the lengths to trim don't go together")
    say("coverage.fragmentLength" in has and not on("coverage.extendReads"), "coverage.fragmentLength needs coverage.extendReads")
    for key, known in (("analyzeVariants.callingFilters", calling_filters), ("analyzeVariants.postFilters", post_filters)):
        say(bool(known) and not set(listed(has, key)) <= set(known), f"{key} names an unknown filter")
    return out
