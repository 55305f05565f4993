"""Readers. A feed is named by format and options, so a topic and a folder of files read alike."""
