"""Where changelogs come from and where they are kept."""
