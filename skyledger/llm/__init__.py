"""Operators for preparing large text collections for training; nothing else imports them."""
