"""The composed jobs: links, frontier, answers, comments and instructions."""
