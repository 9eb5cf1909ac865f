"""Readers: ERP tables, mail messages, notifications; and the stage folder."""
