"""Settings that every plan takes; nothing here is global state."""

from dataclasses import dataclass

@dataclass(frozen=True)
class Settings:
    # Load constants, folder names and author texts.
    floor_days: int = 30
    first_lookback_days: int = 7
    author_hour_shift: int = -3
    excluded_folders: tuple = (".git", ".idea", ".sync", "PLSQL", "TESTS")
    logged_actions: tuple = ("INSERTED", "UPDATED")
    unknown_author: str = "Неизвестный автор"
    mail_suffix: str = "@mail"
    committer: str = "sources_sync_job"
    message_prefix: str = "autosave "
    base_epoch: str = "master"

    # Objects listed in one message; the messages of a larger change set are numbered.
    names_per_message: int = 100_000
    # Lines joined in one task before the blocks of a long text are put together.
    lines_per_block: int = 4096
    # Polls after which a store is folded (0: never by itself), and the age in hours from which folders
    # that no reader needs are removed then.
    polls_per_fold: int = 100
    keep_hours: float = 24.0
    # How often a poll looks again when another one of the same source was faster.
    commit_tries: int = 5
