"""quire.streaming"""
